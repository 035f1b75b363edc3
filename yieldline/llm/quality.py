"""Line-first quality rules, with DataFrame functions only and no shuffle.

Every line with a word is judged by itself: punctuation, navigation, symbols, known boilerplate. Lines that fail are
removed, and a document that loses too much of its text is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline.llm.names import apart_from_input

# Fixed values of the contract.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
LEAST_WORDS = 50
MOST_REPEATED = 50

# Rules of a line. A line without any of these marks is a title, a menu entry or a table cell.
SENTENCE_MARK = r"[.!?…:;。！？]"
# Separators between menu entries or breadcrumbs.
SEPARATOR = r" [|»›·•>] "
MOST_SEPARATORS = 2
# Symbols for each 100 words.
MOST_SYMBOLS = 10
BOILERPLATE = (
    r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|accept (all )?cookies|"
    r"enable javascript|skip to (main )?content|sign up for our newsletter|subscribe to our newsletter|click here to|"
    r"alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)"
)
# Share of the words' characters, in percent, that failing lines may hold.
MOST_LOST = 30


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def _symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, NOT_SYMBOLS, ""))


def line_fails(line: Column) -> Column:
    """Whether a line is removed."""
    return (
        ~line.rlike(SENTENCE_MARK)
        | (F.regexp_count(line, F.lit(SEPARATOR)) >= MOST_SEPARATORS)
        | (100 * _symbols(line) > MOST_SYMBOLS * _words(line))
        | line.rlike(BOILERPLATE)
    )


def _chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(text, BLANK, ""))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that the text holds twice or more.

    Windows are sorted by a 64-bit hash with their place, so equal ones are neighbours; each place found adds the words
    that the place before it has not yet covered. `words` must be a plain column.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")),
    )
    return F.when(F.size(words) >= 3, F.sort_array(windows))


def _covered(places: Column) -> Column:
    return F.aggregate(
        F.sort_array(places),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda sofar, at: F.struct((sofar["n"] + F.least(F.lit(3), at - sofar["last"])).alias("n"), at.alias("last")),
        lambda sofar: sofar["n"],
    )


@apart_from_input
def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept and cleaned.

    `cleaned` is the text without failing lines. Null text has no words, fails, and stays null. White space is
    U+0020 and U+0009 to U+000D only. Columns of the same names are replaced; all others and all rows stay.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cleaned"]
    base = docs.drop(*new)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    first = base.withColumns(
        {
            "__words": F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)),
            "__lines": F.split(whole, "\n", -1),
            "__chars": _chars(whole),
            "__symbols": _symbols(whole),
        }
    )
    second = first.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "__sorted": repeated_words(F.col("__words")),
            "__real": F.filter("__lines", lambda line: line.rlike(WORD)),
            "__good": F.filter("__lines", lambda line: ~line.rlike(WORD) | ~line_fails(line)),
        }
    ).drop("__words", "__lines")
    third = second.withColumns(
        {
            "__places": F.transform(
                F.filter(
                    "__sorted",
                    lambda w, i: (w["h"] == F.get("__sorted", i - 1)["h"]) | (w["h"] == F.get("__sorted", i + 1)["h"]),
                ),
                lambda w: w["at"],
            ),
            "cleaned": F.when(F.col(text).isNotNull(), F.array_join("__good", "\n")),
        }
    ).drop("__sorted")
    fourth = third.withColumns(
        {
            "word_chars": F.col("__chars").cast("long"),
            "n_symbols": F.col("__symbols").cast("long"),
            "n_dup_lines": (F.size("__real") - F.size(F.array_distinct("__real"))).cast("long"),
            "n_repeat_words": F.when(F.size("__places") > 0, _covered(F.col("__places"))).otherwise(0).cast("long"),
            "__left": _chars(F.coalesce("cleaned", F.lit(""))).cast("long"),
        }
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    enough = 100 * (F.col("word_chars") - F.col("__left")) <= MOST_LOST * F.col("word_chars")
    last = fourth.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)
    return last.select(*[F.col(f"`{c}`") for c in base.columns], *new)


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that are kept, their text without failing lines, with their own columns."""
    marked = measure(docs, text).where("kept")
    return marked.select(*[F.col("cleaned").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def checking_sql() -> str:
    """The measures in DuckDB, by grouping whole windows."""
    fails = (
        f"NOT regexp_matches(x, '{SENTENCE_MARK}') "
        f"OR len(regexp_extract_all(x, '{SEPARATOR}')) >= {MOST_SEPARATORS} "
        f"OR 100 * len(regexp_extract_all(x, '{SYMBOLS}')) > {MOST_SYMBOLS} * len(regexp_extract_all(x, '{WORD}')) "
        f"OR regexp_matches(x, '{BOILERPLATE}')"
    )
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS w FROM docs
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS pos, w FROM words WHERE len(w) >= 3
), found AS (
  SELECT doc_id, pos FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, w[pos], w[pos + 1], w[pos + 2]) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS place FROM found) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM docs
), real AS (
  SELECT doc_id, x, length(regexp_replace(x, '{BLANK}', '', 'g')) AS n, {fails} AS bad FROM lines WHERE regexp_matches(x, '{WORD}')
), summed AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS dup, sum(n) FILTER (WHERE bad) AS lost, sum(n) AS chars FROM real GROUP BY doc_id
), measured AS (
  SELECT d.doc_id, len(d.w) AS n_words, CAST(coalesce(s.chars, 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(d.t, '{SYMBOLS}')) AS n_symbols, coalesce(s.dup, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(s.lost, 0) AS lost
  FROM words d LEFT JOIN summed s ON s.doc_id = d.doc_id LEFT JOIN covered c ON c.doc_id = d.doc_id
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
         AND 100 * lost <= {MOST_LOST} * word_chars AS kept
FROM measured
"""
