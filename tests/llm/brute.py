"""Plain versions of the operators, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def least_reachable(ids, linked):
    """Smallest id that links reach, by id. `linked` gives pairs."""
    label = {i: i for i in ids}
    pairs = list(linked)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            if (label[a], label[b]) != (m, m):
                label[a] = label[b] = m
                changed = True
    return label


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_duplicates(pairs, percent=75):
    sets = {i: shingles(t) for i, t in pairs}
    linked = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    label = least_reachable(sets, linked)
    return {i: (len(sets[i]), label[i]) for i in sets}


def repeated_bytes(pairs, length=100):
    first, out = {}, {}
    for i, text in sorted(pairs):
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            first.setdefault(data[at : at + length], (i, at))
    for i, text in pairs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] != (i, at):
                gone[at : at + length] = b"\1" * length
        kept = bytes(x for x, y in zip(data, gone) if not y)
        spans = sum(1 for at in range(len(gone)) if gone[at] and not (at and gone[at - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeated_lines(pairs, min_lines=3, min_chars=250, min_words=8):
    """doc_id to its lines that are left, by comparing all runs of up to min_lines lines."""
    first, found = {}, []
    for i, text in sorted(pairs):
        real = [(n, x.strip(" \t\n\x0b\x0c\r")) for n, x in enumerate((text or "").split("\n"))]
        real = [(n, x) for n, x in real if x]
        for at in range(len(real)):
            for size in range(1, min(min_lines, len(real) - at) + 1):
                run = tuple(x for _, x in real[at : at + size])
                words = sum(len(WORD.findall(x)) for x in run)
                if size == min_lines or sum(map(len, run)) >= min_chars or words >= min_words:
                    if first.setdefault(run, (i, at)) != (i, at):
                        found += [(i, n) for n, _ in real[at : at + size]]
    gone = set(found)
    return {i: [x for n, x in enumerate((text or "").split("\n")) if (i, n) not in gone] for i, text in pairs}


def bytes_left(pairs, length=100):
    """doc_id to the text without later copies of byte runs; characters that were cut are left out."""
    first, out = {}, {}
    for i, text in sorted(pairs):
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            first.setdefault(data[at : at + length], (i, at))
    for i, text in pairs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] != (i, at):
                gone[at : at + length] = b"\1" * length
        out[i] = None if text is None else bytes(x for x, y in zip(data, gone) if not y).decode("utf-8", "ignore")
    return out


def with_texts(rows, texts):
    """Rows (doc_id, text, n_chars) with new texts by doc_id, without those that removal emptied."""
    out = []
    for i, text, n in rows:
        new = text if i is None else texts[i]
        if new == text:
            out.append((i, text, n))
        elif WORD.search(new):
            out.append((i, new, len(new)))
    return out


def named(rows):
    return list({(i, t) for i, t, _ in rows if i is not None})


def line_stage(rows):
    left = repeated_lines(named(rows))
    return with_texts(rows, {i: None if t is None else "\n".join(left[i]) for i, t in named(rows)})


def near_stage(rows):
    kept = near_duplicates(named(rows))
    return [r for r in rows if r[0] is None or kept[r[0]][1] == r[0]]


def passage_stage(rows):
    return with_texts(rows, bytes_left(named(rows)))
