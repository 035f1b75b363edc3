"""Line dedup by winnowing: find runs of lines that stood earlier, and delete the later ones.

A window is the shortest run of lines from some line on that has `min_lines` lines or `min_chars` characters. Its fingerprint
is the line in it with the least hash, so equal windows have equal fingerprints at equal places, and neighbouring
windows mostly share one. Only fingerprints are counted over the corpus; lines whose fingerprint is met once are done.
Around each shared fingerprint the windows that chose it are compared by content, which extends a match to both sides
as far as it goes. A window that occurred earlier (smaller key, or same document and earlier line) is repeated, and the
lines of repeated windows are deleted.

With `min_words`, runs of fewer lines with so many words are windows too, as they do not recur by chance either. Then a line
can start windows of several sizes; those whose lines smaller windows hold already are left out.

DataFrame functions only. Counts and first places are combined before each shuffle, and written before windows are joined with
them, so that adaptive execution can split the windows of one very common line over several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline.llm.components import stored
from yieldline.llm.names import apart_from_input

BLANKS = " \t\n\x0b\x0c\r"

# Words of a line or short run that does not recur by chance. Scripts without spaces count two characters as a word.
MIN_WORDS = 8
SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
UNSPACED = "".join(rf"\p{{Is{s}}}" for s in SCRIPTS)
WORD = rf"[{UNSPACED}]{{1,2}}|[^ \t-\r{UNSPACED}]+"
# Ranges that hold these scripts and some others; looked at first, as scripts are dear to tell.
MAY_BE_UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u19E0-\u19FF\u2E80-\uABFF\uF900-\uFAFF\uFF00-\uFFEF\x{10000}-\x{10FFFF}]"


def lines_of(text: Column) -> Column:
    """Lines between line feeds; null is one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def windows(docs: DataFrame, key: str, text: str, min_lines: int, min_chars: int, min_words: int | None = None) -> DataFrame:
    """One row per window: key, at (its first line among those with text), mark (hash of the selected line), place (where that
    is), h and g (hashes of the content), lines (line numbers)."""
    lines = F.transform(lines_of(F.col(text)), lambda line, i: F.struct(i.alias("i"), F.btrim(line, F.lit(BLANKS)).alias("x")))
    real = F.transform(
        F.filter(lines, lambda line: line["x"] != ""),
        lambda line: F.struct(
            line["i"].alias("i"),
            F.length(line["x"]).alias("n"),
            F.xxhash64(line["x"]).alias("h"),
            F.xxhash64(F.lit("second"), line["x"]).alias("g"),
            *([] if min_words is None else [_words(line["x"], min_chars).alias("words")]),
        ),
    )
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), real.alias("real"))
    # Each line next to those after it, so that a window is one row and needs no look into the array.
    beside = [F.expr(f"slice(real, {j + 1}, size(real))").alias(f"r{j}") for j in range(min_lines)]
    lined = rows.where(F.size("real") > 0).select("key", *beside)
    beside = lined.select("key", F.posexplode(F.arrays_zip(*[f"r{j}" for j in range(min_lines)])).alias("at", "w"))
    sized = beside.withColumn("size", _shortest(min_lines, min_chars) if min_words is None else F.explode(_sizes(min_lines, min_chars, min_words)))
    sized = sized.where("size IS NOT NULL")

    def within(field: str) -> list[Column]:
        return [F.when(F.col("size") > j, F.col("w")[f"r{j}"][field]) for j in range(min_lines)]

    marked = sized.select(
        "key",
        "at",
        F.array_min(F.array_compact(F.array(*[F.when(F.col("size") > j, F.struct(h, i)) for j, (h, i) in enumerate(zip(within("h"), within("i"), strict=True))]))).alias("least"),
        F.xxhash64("size", *within("h")).alias("h"),
        F.xxhash64("size", *within("g")).alias("g"),
        F.array_compact(F.array(*within("i"))).alias("lines"),
    )
    return marked.select("key", "at", F.col("least.col1").alias("mark"), F.col("least.col2").alias("place"), "h", "g", "lines")


def _words(line: Column, min_chars: int) -> Column:
    """Words of a line; 0 if it counts by its characters alone."""
    unspaced = F.regexp_count(line, F.lit(WORD))
    spaced = F.regexp_count(line, F.lit(r"[^ \t-\r]+"))
    return F.when(F.length(line) >= min_chars, 0).when(line.rlike(MAY_BE_UNSPACED), unspaced).otherwise(spaced)


def _total(field: str, start: int, end: int) -> Column:
    """Sum of a field of w over the lines from start to before end, null if the document ends before."""
    return reduce(lambda a, b: a + b, [F.col("w")[f"r{j}"][field] for j in range(start, end)])


def _shortest(min_lines: int, min_chars: int) -> Column:
    """Lines of the shortest window from a line on, or null."""
    size = F.lit(None).cast("int")
    for n in range(min_lines, 0, -1):
        there = F.col("w")[f"r{n - 1}"]["n"].isNotNull()
        size = F.when(there if n == min_lines else there & (_total("n", 0, n) >= min_chars), n).otherwise(size)
    return size


def _sizes(min_lines: int, min_chars: int, min_words: int) -> Column:
    """Lines of every window from a line on, without those that two windows of one line less make up."""

    def counts(start: int, end: int) -> Column:
        if end - start == min_lines:
            return F.col("w")[f"r{end - 1}"]["n"].isNotNull()
        return F.coalesce((_total("n", start, end) >= min_chars) | (_total("words", start, end) >= min_words), F.lit(False))

    kept = [counts(0, 1), *[counts(0, n) & ~(counts(0, n - 1) & counts(1, n)) for n in range(2, min_lines + 1)]]
    return F.array_compact(F.array(*[F.when(c, n) for n, c in enumerate(kept, 1)]))


def repeated_lines(
    docs: DataFrame, key: str, text: str, min_lines: int = 3, min_chars: int = 250, min_words: int | None = None
) -> DataFrame:
    """key, lines: the numbers (from 0) of lines to delete, for documents that have any."""
    every = stored(windows(docs, key, text, min_lines, min_chars, min_words), "windows")
    marks = every.groupBy("mark").agg(F.min(F.struct("key", "place")).alias("a"), F.max(F.struct("key", "place")).alias("b"))
    marks = stored(marks.where("a <> b").select("mark"), "marks")
    shared = every.join(marks, "mark", "left_semi").drop("mark", "place")
    first = shared.groupBy("h", "g").agg(F.min(F.struct("key", "at")).alias("first"), F.max(F.struct("key", "at")).alias("last"))
    first = stored(first.where("first <> last").drop("last"), "firsts")
    later = (
        shared.join(first, ["h", "g"])
        .where(F.struct("key", "at") != F.col("first"))
        .select("key", "lines")
    )
    return later.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))


@apart_from_input
def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = 3, min_chars: int = 250, min_words: int | None = None
) -> DataFrame:
    """`docs` with later repeated runs of lines deleted from `text`, and `n_lines`, `n_removed_lines` added.

    Lines are compared without white space at their ends; blank lines are skipped in a run and stay. A run shorter
    than `min_lines` lines and `min_chars` characters, and than `min_words` words if given, stays wherever it is. Null text stays null and has no lines; a
    row without a key is neither compared nor changed. Rows repeated with the same key and text are one document and
    get the same result. Columns named n_lines or n_removed_lines are replaced; all others stay.
    """
    found = repeated_lines(docs, key, text, min_lines, min_chars, min_words).select(
        F.col("key").alias("__key"), F.col("lines").alias("__drop")
    )
    base = docs.drop("n_lines", "n_removed_lines")
    joined = base.join(found, base[key] == found["__key"], "left").drop("__key")
    numbered = joined.withColumn("__lines", lines_of(F.col(text)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    cleaned = F.when(
        F.col("__drop").isNotNull(), F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")
    ).otherwise(F.col(text))
    return numbered.select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in base.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size("__lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )


def checking_sql(min_lines: int = 3, min_chars: int = 250, min_words: int = MIN_WORDS) -> str:
    """The digest of op7 in DuckDB, by comparing whole windows."""
    scripts = "".join(rf"\p{{{s}}}" for s in SCRIPTS)
    words = rf"len(regexp_extract_all(x, '[{scripts}]{{1,2}}|[^ \t-\r{scripts}]+'))"

    def counts(start: int, end: int) -> str:
        if end - start == min_lines:
            return f"pos + {end - 1} <= n"
        total = [" + ".join(f"lead({c}, {j}) OVER d" for j in range(start, end)) for c in ("chars", "words")]
        return f"coalesce({total[0]} >= {min_chars} OR {total[1]} >= {min_words}, false)"

    kept = [counts(0, 1), *[f"{counts(0, n)} AND NOT ({counts(0, n - 1)} AND {counts(1, n)})" for n in range(2, min_lines + 1)]]
    sizes = ", ".join(f"CASE WHEN {c} THEN {n} END" for n, c in enumerate(kept, 1))
    return rf"""
WITH cut AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), listed AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS raw FROM cut
), trimmed AS (
  SELECT doc_id, i, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM listed
), real AS (
  SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos,
         count(*) OVER (PARTITION BY doc_id) AS n, length(x) AS chars, {words} AS words
  FROM trimmed WHERE x <> ''
), starts AS (
  SELECT doc_id, pos, [{sizes}] AS sizes FROM real WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), sized AS (
  SELECT doc_id, pos, unnest(sizes) AS size FROM starts
), windows AS (
  SELECT s.doc_id, s.pos, s.size, string_agg(r.x, chr(10) ORDER BY r.pos) AS content
  FROM sized s JOIN real r ON r.doc_id = s.doc_id AND r.pos BETWEEN s.pos AND s.pos + s.size - 1
  WHERE s.size IS NOT NULL GROUP BY s.doc_id, s.pos, s.size
), later AS (
  SELECT doc_id, pos, size FROM windows
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT DISTINCT r.doc_id, r.i FROM later l JOIN real r ON r.doc_id = l.doc_id AND r.pos BETWEEN l.pos AND l.pos + l.size - 1
), kept AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text, count(g.i) AS n_removed_lines
  FROM listed l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
)
SELECT c.doc_id, CASE WHEN c.text IS NULL THEN 0 ELSE len(c.lines) END AS n_lines, k.n_removed_lines,
       CASE WHEN c.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
FROM cut c JOIN kept k ON k.doc_id = c.doc_id
"""
