"""Token ids of whole columns, equal to those of the tokenizers library.

Texts are cut where a cut cannot change the ids, the distinct fragments of a slice are encoded by the
library once, and the ids are put together again. A text for which the cuts are not certain is encoded
whole by the library.
"""

from __future__ import annotations

import gc
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from yieldline.llm.columns import flat, gathered, strings

# Fragments whose ids a worker remembers between slices; the memory is bounded, the result does not depend on it.
REMEMBERED = 60_000

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3


def vocabulary_path(name: str) -> str:
    """Where the installed vocabulary file of that name is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _unicode_to_byte() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_SPELLING = {byte: letter for letter, byte in _unicode_to_byte().items()}
_ONE_WORD = re.compile(r" ?(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]+|[!-/:-@\[-`{-~]+)").fullmatch


class Encoder:
    """Shared part: remembers fragments and puts ids together."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            self._prepare(json.load(file))
        self._known: dict[str, tuple[int, ...]] = {}
        self._most = remembered

    def _prepare(self, description: dict) -> None:
        """Keep what is needed of the vocabulary file."""
        self.special = [t["content"] for t in description["added_tokens"]]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _ids_of(self, fragments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the fragments one after the other, and how many each has."""
        known = self._known
        if len(known) > self._most:
            known.clear()
        model, split = self.library.model, []
        collects = gc.isenabled()
        gc.disable()  # the many small tuples hold no cycles
        for fragment in fragments:
            if fragment not in known:
                if self._one_word(fragment):
                    spelt = fragment if fragment.isascii() else fragment.encode().decode("latin-1")
                    known[fragment] = tuple(t.id for t in model.tokenize(spelt.translate(_SPELLING)))
                else:
                    split.append(fragment)
        for first in range(0, len(split), 20_000):
            some = split[first : first + 20_000]
            for fragment, made in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[fragment] = tuple(made.ids)
        if collects:
            gc.enable()
        lists = [known[f] for f in fragments]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths

    def _one_word(self, fragment: str) -> bool:
        """Whether the pre-tokenizer leaves the fragment as it is, so that the library's model takes it directly."""
        raise NotImplementedError

    def certain(self, column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows whose fragments may be encoded apart."""
        apart = np.ones(len(column), bool)
        for content in self.special:
            apart &= ~pc.fill_null(pc.match_substring(column, content), False).to_numpy(zero_copy_only=False)
        return apart

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The fragments as a string column, and how many each row has."""
        raise NotImplementedError

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and where each row begins. Null is empty."""
        data, offsets = flat(column)
        apart = self.certain(column, data, offsets)
        if not apart.all():
            return self._with_whole_rows(column, apart)
        parts, per_row = self.fragments(data, offsets)
        coded = parts.dictionary_encode()
        ids, lengths = self._ids_of(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy(zero_copy_only=False)
        starts = (np.cumsum(lengths) - lengths)[index]
        per_part = lengths[index]
        ends = np.concatenate([[0], np.cumsum(per_part)])
        return gathered(ids, starts, per_part), ends[np.concatenate([[0], np.cumsum(per_row)])]

    def _with_whole_rows(self, column: pa.Array, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, offsets = self.column(pc.if_else(pa.array(apart), column, pa.scalar("", column.type)))
        rows = [ids[offsets[i] : offsets[i + 1]] if apart[i] else self.whole(column[i].as_py()) for i in range(len(column))]
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return np.concatenate(rows).astype(np.uint32), ends


class ForcedBoundaryEncoder(Encoder):
    """Byte-level BPE. A pair of bytes that no token contains is a certain cut: no merge can cross it.

    The pre-tokenizer must not notice the cut either. It looks ahead only after white space, and
    a contraction may begin only where a run of punctuation does, so there is no cut after white space and
    none between other punctuation and an apostrophe; and none inside a character.
    """

    def _prepare(self, description: dict) -> None:
        super()._prepare(description)
        back = _unicode_to_byte()
        tokens = {i: bytes(back[c] for c in t) for t, i in description["model"]["vocab"].items()}
        tokens |= {t["id"]: t["content"].encode() for t in description["added_tokens"]}
        self.token_bytes = pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.large_binary())
        seen = np.zeros((256, 256), bool)
        for token in tokens.values():
            seen[list(token[:-1]), list(token[1:])] = True
        after = np.arange(256)
        seen[:, (after >= 0x80) & (after < 0xC0)] = True
        seen[[9, 10, 11, 12, 13, 32], :] = True
        word = [*range(48, 58), *range(65, 91), *range(97, 123)]
        seen[np.setdiff1d(after, word), ord("'")] = True
        self._cut = ~seen.reshape(-1)
        # After a character of two bytes from U+00C0 on, none of which is white space, or an ASCII one.
        self._second = (after >= 0xC3) & (after < 0xE0)

    def _one_word(self, fragment: str) -> bool:
        return _ONE_WORD(fragment) is not None

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            pairs = data[:-1].astype(np.uint16)
            pairs <<= 8
            pairs |= data[1:]
            inner = self._cut[pairs]
            wide = np.flatnonzero(inner & (data[:-1] >= 0x80))
            inner[wide[~self._second[data[np.maximum(wide - 1, 0)]]]] = False
            cut[1:-1] = inner
        cut[offsets] = True
        ends = np.flatnonzero(cut)
        if not len(data):
            return pa.array([], pa.string()), np.zeros(len(offsets) - 1, np.int64)
        return strings(data, ends), np.diff(np.searchsorted(ends, offsets))

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Text of each row in UTF-8 as the library's decode gives it, special tokens included."""
        back = self.token_bytes.take(pa.array(ids))
        data, at = flat(back)
        ends = at[offsets]
        whole = data.tobytes()
        return [whole[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends[:-1], ends[1:], strict=True)]


class LowerCaseWordEncoder(Encoder):
    """BPE with word ends over lower-cased text. Words, single digits and punctuation runs are encoded apart.

    Certain for texts of ASCII and Latin-1 letters, which lower-casing and composition treat byte by byte;
    other texts are encoded whole.
    """

    def _prepare(self, description: dict) -> None:
        super()._prepare(description)
        kind = np.full(256, OTHER, np.uint8)
        kind[[9, 10, 11, 12, 13, 32]] = SPACE
        kind[48:58] = DIGIT
        kind[97:123] = kind[128:] = LETTER
        self._kind = kind
        allowed = np.zeros(256, bool)
        allowed[[9, 10, 11, 12, 13, *range(32, 127)]] = True
        self._ascii = allowed

    def certain(self, column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        fine = self._ascii[data]
        lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.empty(0, np.int64)
        second = data[lead + 1]
        lead = lead[(second != 0x97) & (second != 0xB7)]
        fine[lead] = fine[lead + 1] = True
        bad = np.concatenate([[0], np.cumsum(~fine)])
        return super().certain(column, data, offsets) & (bad[offsets[1:]] == bad[offsets[:-1]])

    def _one_word(self, fragment: str) -> bool:
        return True

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        if not len(data):
            return pa.array([], pa.string()), np.zeros(len(offsets) - 1, np.int64)
        low = data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        wide = np.flatnonzero(data == 0xC3) + 1
        low[wide[(data[wide] <= 0x9E) & (data[wide] >= 0x80)]] += 32
        kind = self._kind[low]
        start = np.empty(len(low) + 1, bool)
        start[0] = start[-1] = True
        start[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        start[offsets] = True
        rows = np.zeros(len(low) + 1, bool)
        rows[offsets] = True
        self._contractions(low, kind, start, rows)
        ends = np.flatnonzero(start)
        words = kind[ends[:-1]] != SPACE
        lengths = np.diff(ends)[words]
        row = np.searchsorted(offsets, ends[:-1][words], side="right") - 1
        return strings(low[kind != SPACE], np.concatenate([[0], np.cumsum(lengths)])), np.bincount(row, minlength=len(offsets) - 1)

    @staticmethod
    def _contractions(low: np.ndarray, kind: np.ndarray, start: np.ndarray, rows: np.ndarray) -> None:
        """An apostrophe that is a run of its own takes s, t, m, d, re, ve or ll that follow it in its row."""
        next_ = np.flatnonzero((low[:-1] == ord("'")) & start[:-2] & ~rows[1:-1] & (kind[1:] == LETTER)) + 1
        follows = low[next_]
        one = np.isin(follows, np.frombuffer(b"stmd", np.uint8))
        far = np.minimum(next_ + 1, len(low) - 1)
        joined = (next_ + 1 < len(low)) & ~start[far]
        two = joined & np.isin(
            follows.astype(np.int32) * 256 + low[far], [256 * a + b for a, b in (b"re", b"ve", b"ll")]
        )
        start[next_[one | two]] = False
        start[next_[one] + 1] = True
        start[next_[two] + 2] = True
