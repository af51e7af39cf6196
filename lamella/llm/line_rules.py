"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, digits as 0, white space collapsed) and hashed
with their host. A line is boilerplate when more than ``floor`` different documents
of its host hold it, and these are more than ``share`` of that host's different
documents or more than ``most``. So a host of a few documents loses its planted
lines, and the largest host loses a line of many documents whatever their share.
Boilerplate lines are removed; a document that loses ``depleted`` of its words or
more, or that fails the base rules, is rejected. Exact copies count as one
document, so that a much copied page does not make its own lines boilerplate
(removing copies is the near-duplicate operator's work).

How it scales: one pass over the texts writes their counts and, per line, a hash
and a size; everything after it reads these numbers. Counts per line combine
before the shuffle, with plain counts first; only lines above their host's limit by plain
count are counted again by different text. The lines over their limit number at most (all lines) / ``floor``. Up to
``LISTED`` of them are named in the plan, so that the texts do not move; beyond
that the same rows come from joins on the hash.

Defined cases: NULL text counts as empty (no words, rejected by the base rules).
NULL hosts are one host. Empty and blank lines are never boilerplate. Repeated
rows get equal results. Empty tables give empty results. Extra columns stay; one
named like a result gives way to it in ``judge`` and stays in ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import SPACE, written

FLOOR = 3
SHARE = 0.02
MOST = 1000
DEPLETED = 0.8
LISTED = 4096
WINDOW = 5
BLANKS = " \t\n\x0b\x0c\r"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rest")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _paired(values: Column, by: int, other: Column | None = None) -> Column:
    """Hash of each element with the one ``by`` places on; shorter by ``by``."""
    left = F.slice(values, 1, F.greatest(F.least(F.size(values), F.size(other if other is not None else values) - by), F.lit(0)))
    return F.zip_with(left, _shifted(other if other is not None else values, by), lambda a, b: F.xxhash64(a, b))


def with_window_hashes(df: DataFrame, words: str, name: str) -> DataFrame:
    """Add a hash of the five words from each place on. Each step is a column of its own, so none is computed twice."""
    return (df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))
              .withColumn("_h2", _paired(F.col("_h1"), 1))
              .withColumn("_h4", _paired(F.col("_h2"), 2))
              .withColumn(name, _paired(F.col("_h4"), 4, F.col("_h1")))
              .drop("_h1", "_h2", "_h4"))


def with_repeat_words(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """Add the number of words inside windows that occur twice or more, first ones included.

    Places are sorted by hash next to each other; those with an equal neighbour are
    repeats. In order of place, each covers its five words or those up to the next one.
    """
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    placed = F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    first = df.withColumn("_s", F.when(repeats, F.sort_array(placed)))
    size = F.size("_s")
    second = first.withColumn("_next", F.zip_with(
        F.slice("_s", 1, size - 1), F.slice("_s", 2, size - 1), lambda a, b: a["h"] == b["h"]))
    either = F.zip_with(F.concat("_next", F.array(F.lit(False))), F.concat(F.array(F.lit(False)), "_next"), lambda a, b: a | b)
    places = F.zip_with("_s", either, lambda s, e: F.when(e, s["i"]))
    third = second.withColumn("_p", F.sort_array(F.array_compact(places)))
    count = F.size("_p")
    gaps = F.zip_with(F.slice("_p", 1, count - 1), F.slice("_p", 2, count - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW).cast("bigint"), lambda total, gap: total + gap)
    return third.withColumn(name, F.when(F.col("_p").isNotNull(), covered).otherwise(F.lit(0)).cast("bigint")).drop("_s", "_next", "_p")


def prepared(docs: DataFrame, text: str, host: str) -> DataFrame:
    """The input columns under numbered names, which nothing here clashes with, and ``body`` and ``host``."""
    named = docs.toDF(*[f"in_{i}" for i in range(len(docs.columns))])
    own = {c: F.col(f"in_{i}").cast("string") for i, c in enumerate(docs.columns)}
    return named.withColumns({"body": F.coalesce(own[text], F.lit("")), "host": own[host]})


def with_base(rows: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of ``body``, and of each of its lines,
    in order, ``keys`` (NULL without a word) and ``sizes`` (characters in words)."""
    body = F.col("body")
    symbols = F.when(body.rlike("[#*$%&|<>]"), F.char_length(body) - F.char_length(F.translate(body, "#*$%&|<>", ""))).otherwise(F.lit(0))
    worded = F.filter("_lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = (rows.withColumn("_words", words_of(body)).withColumn("_lines", F.split(body, "\n", -1))
              .withColumn("keys", line_keys(body, F.col("host")))
              .withColumn("sizes", F.transform("_lines", lambda line: F.char_length(F.translate(line, BLANKS, ""))))
              .withColumn("n_words", F.size("_words").cast("bigint"))
              .withColumn("word_chars", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda total, size: total + size))
              .withColumn("n_symbols", symbols.cast("bigint"))
              .withColumn("_worded", worded)
              .withColumn("n_dup_lines", (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("bigint")))
    df = with_repeat_words(with_window_hashes(df, "_words", "_w5"), "_w5", "n_repeat_words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_words", "_lines", "_worded", "_w5")


def line_keys(text: Column, host: Column) -> Column:
    """Hash of each normalised line with its host, in order; NULL for a line without words.

    The text is normalised as a whole before it is cut, which costs less than line by line: no step takes or makes a line end.
    """
    same = F.regexp_replace(F.translate(F.lower(text), "123456789", "000000000"), r"[\x20\x09\x0B-\x0D]+", " ")
    plain = F.split(F.regexp_replace(same, r"(?<![^\n]) | (?=\n|\z)", ""), "\n", -1)
    return F.transform(plain, lambda line: F.when(line != "", F.xxhash64(line, F.coalesce(host, F.lit("")), host.isNull())))


def measured(docs: DataFrame, text: str, host: str, with_body: bool) -> DataFrame:
    """The rows with all that one pass over the texts tells, written once: the steps after it read numbers, and the texts
    only if they are asked for (``with_body``)."""
    own = F.col(f"in_{docs.columns.index(text)}")
    rows = with_base(prepared(docs, text, host)).withColumns({"doc": F.xxhash64("body"), "absent": own.isNull()})
    texts = [f"in_{docs.columns.index(text)}"] + ([] if with_body else ["body"])
    return written(rows.drop(*texts), "line-keys")


def _keyed(rows: DataFrame) -> DataFrame:
    """One row per document and different line: hash of the whole text, host, line key."""
    return rows.select("doc", "host", F.explode(F.array_distinct(F.array_compact("keys"))).alias("key"))


def boilerplate(rows: DataFrame, floor: int = FLOOR, share: float = SHARE, most: int | None = MOST) -> DataFrame:
    """``key`` of the lines over the limit of their host, for ``measured`` rows."""
    keyed = _keyed(rows)
    sizes = written(rows.select(F.col("host").alias("of"), "doc").distinct().groupBy("of").agg(F.count(F.lit(1)).alias("docs")), "hosts")

    def over(lines: DataFrame) -> DataFrame:
        counted = lines.groupBy("key", "host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > floor)
        limit = F.col("n") > share * F.col("docs")
        return counted.join(sizes, F.col("host").eqNullSafe(F.col("of"))).filter(
            limit if most is None else limit | (F.col("n") > most)).select("key")
    frequent = written(over(keyed), "frequent-lines")
    few = frequent.limit(LISTED + 1).collect()
    if len(few) <= LISTED:
        again = keyed.filter(F.col("key").isin([r[0] for r in few]))
    else:
        again = keyed.join(frequent, "key", "left_semi")
    return written(over(again.distinct()), "boilerplate")


def with_flags(rows: DataFrame, over: DataFrame) -> DataFrame:
    """``measured`` rows with ``gone``: for each line whether it is boilerplate."""
    few = over.limit(LISTED + 1).collect()
    if len(few) <= LISTED:
        listed = [r[0] for r in few]
        return rows.withColumn("gone", F.transform("keys", lambda key: F.coalesce(key.isin(listed), F.lit(False))))
    # Too many to name: the keys to remove come per different text, by joins on hashes.
    held = _keyed(rows).join(over, "key", "left_semi").distinct()
    per_doc = held.groupBy(F.col("doc").alias("of_doc"), F.col("host").alias("of")).agg(F.collect_set("key").alias("own"))
    joined = rows.join(per_doc, (F.col("doc") == F.col("of_doc")) & F.col("host").eqNullSafe(F.col("of")), "left")
    gone = F.transform("keys", lambda key: F.coalesce(F.array_contains("own", key), F.lit(False)))
    return joined.withColumn("gone", gone).drop("of_doc", "of", "own")


def _judged(docs: DataFrame, text: str, host: str, floor: int, share: float, most: int | None, depleted: float, with_rest: bool) -> DataFrame:
    rows = measured(docs, text, host, with_rest)
    flagged = with_flags(rows, boilerplate(rows, floor, share, most))
    lost = F.aggregate(F.zip_with("sizes", "gone", lambda size, gone: F.when(gone, size).otherwise(F.lit(0))),
                       F.lit(0).cast("bigint"), lambda total, size: total + size)
    judged = flagged.withColumn("kept", ~F.col("base_failed") & (lost < depleted * F.col("word_chars")))
    if not with_rest:
        return judged
    stay = F.zip_with(F.split("body", "\n", -1), F.col("gone"), lambda line, gone: F.when(~gone, line))
    return judged.withColumn("rest", F.when(F.exists("gone", lambda g: g), F.array_join(stay, "\n")).otherwise(F.col("body")))


def judge(docs: DataFrame, text: str = "text", host: str = "source", floor: int = FLOOR, share: float = SHARE,
          depleted: float = DEPLETED, most: int | None = MOST, with_rest: bool = True) -> DataFrame:
    """``docs`` with the base counts, base_failed, kept, and rest, the text without boilerplate lines.

    An input column of the same name as a result gives way to it. Without ``with_rest`` the texts are read
    once and neither written nor returned.
    """
    results = RESULTS if with_rest else RESULTS[:-1]
    at = docs.columns.index(text)
    stay = [(F.when(~F.col("absent"), F.col("body")) if i == at else F.col(f"in_{i}")).alias(c) for i, c in enumerate(docs.columns)
            if c not in results and (with_rest or i != at)]
    return _judged(docs, text, host, floor, share, most, depleted, with_rest).select(*stay, *results)


def clean(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that are kept, all columns, their boilerplate lines removed."""
    judged = _judged(docs, text, host, FLOOR, SHARE, MOST, DEPLETED, True).filter("kept")
    return judged.select(*[(F.col("rest") if c == text else F.col(f"in_{i}")).alias(c) for i, c in enumerate(docs.columns)])
