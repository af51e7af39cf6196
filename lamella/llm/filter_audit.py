"""Filter interaction audit: what five filters remove in every order, by Lehmer-rank difference arrays.

A document is known by its mask, the set of filters that it fails, so the audit
needs the documents once and then works on counts per part and mask (32 masks).
In an order of the filters a mask is removed by the first filter that it fails.
All orders that begin with the same letters stand next to each other in the
lexicographic list, and the Lehmer code of the beginning gives their first rank.
So the orders in which a mask goes at step ``s`` by one filter are intervals of
ranks, one per beginning of ``s`` letters of which only the last is in the mask.
Each interval adds its counts at its first rank and takes them off after its
last; a running sum over the 120 ranks of a part and step gives every total.

How it scales: one pass over the texts leaves 16 bytes of digest, the part and
the mask of a document. Documents with one text are combined before they meet,
so a text with any number of copies is a few rows per part. Rows without a
doc_id are spread over the label join. Everything after is bounded by the
number of parts.

Defined cases: NULL text counts as empty and is identical to an empty one. An
empty text fails A only (and E, if a smaller doc_id has an empty text). NULL
parts count as the empty string. Rows with one doc_id are rows of their own; none
of them is smaller than the other. Rows without a doc_id never fail E, make no
other row fail it, and have no labels. Several labels of one doc_id count as one
that is 1 where any of them is. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, written

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
#: Rows without a doc_id are dealt over so many keys of the label join.
SPREAD = 4_096


def failed(text: str | None) -> tuple[int, bytes]:
    """Bits of the filters A to D that a text fails (A is bit 0), and the digest of the text."""
    whole = text or ""
    raw = whole.encode()
    words = raw.split()  # of bytes: at the blank and \t to \r only
    mask = ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > CAPITAL_PERCENT * len(whole)) << 2
            | (len(raw.translate(None, _SYMBOLS)) < len(raw)) << 3)
    return int(mask), hashlib.sha256(raw).digest()[:16]


def lehmer_rank(letters: str, size: int = len(FILTERS)) -> int:
    """Rank of the first order, in the lexicographic list, that begins with the given filters."""
    left, rank = list(FILTERS[:size]), 0
    for i, letter in enumerate(letters):
        rank += left.index(letter) * factorial(size - 1 - i)
        left.remove(letter)
    return rank


def removal_intervals(mask: int, size: int = len(FILTERS)) -> Iterator[tuple[int, str, int, int]]:
    """Step, filter, first rank and the rank after the last, of all orders in which the filter removes the mask."""
    own = [f for i, f in enumerate(FILTERS[:size]) if mask >> i & 1]
    others = [f for f in FILTERS[:size] if f not in own]
    for before in range(len(others) + 1):
        for passed in permutations(others, before):
            for last in own:
                start = lehmer_rank("".join(passed) + last, size)
                yield before + 1, last, start, start + factorial(size - 1 - before)


def masks(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """part, mask, and the numbers of its documents: docs, good (quality 1) and toxic (toxic 1)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [failed(t) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([m for m, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())],
            names=["id", "part", "mask", "digest"])
    named = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                        F.col(text).cast("string").alias("text"))
    slim = by_batches(named, "id bigint, part string, mask int, digest binary", run)
    # Key 2 is 0 for rows with a doc_id; the others are spread and meet no label.
    spread = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(SPREAD))).otherwise(F.lit(0)).cast("int")
    keyed = slim.select(F.coalesce("id", F.lit(0)).alias("k1"), spread.alias("k2"), "part", "mask", "digest")
    one = F.max(F.coalesce(F.col("quality") == 1, F.lit(False))), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)))
    marked = labels.filter("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").cast("bigint").alias("k1")).agg(
        one[0].alias("good"), one[1].alias("toxic")).withColumn("k2", F.lit(0))
    told = keyed.join(marked, ["k1", "k2"], "left").fillna(False, ["good", "toxic"])
    per_doc = told.groupBy("k1", "k2", "digest", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    # Copies combine here: per text and part remain the count, the smallest doc_id and its rows.
    per_text = per_doc.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("k2") == 0, F.struct("k1", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(F.col("k2") > 0, F.col("n"))), F.lit(0)).alias("unnamed"))
    placed = per_text.withColumn("least", F.min("first.k1").over(Window.partitionBy("digest")))
    at_least = F.when(F.col("first.k1") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    counted = placed.withColumn("late", F.col("n") - F.col("unnamed") - F.coalesce(at_least, F.lit(0)))
    both = F.array(F.struct(F.col("mask").alias("m"), (F.col("n") - F.col("late")).alias("n")),
                   F.struct((F.col("mask") + 16).alias("m"), F.col("late").alias("n")))
    cells = counted.select("part", "good", "toxic", F.explode(both).alias("c")).select("part", F.col("c.m").alias("mask"), F.col("c.n").alias("n"), "good", "toxic")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic")).filter("docs > 0")


def _by_filter(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for f, v in values.items() for x in (F.lit(f), F.sum(v))])


def interactions(cells: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts per part and mask that ``masks`` gives."""
    spark, size = cells.sparkSession, len(FILTERS)
    orders = ["".join(p) for p in permutations(FILTERS)]
    every = {m: list(removal_intervals(m)) for m in range(1, 1 << size)}
    # (mask, step, rank, sign, here): removed at this very step, or (not ``here``) gone since an earlier one.
    ends = [(m, later, rank, sign, later == step) for m, intervals in every.items() for step, _, start, stop in intervals
            for later in range(step, size + 1) for rank, sign in ((start, 1), (stop, -1)) if rank < len(orders)]
    steps = F.broadcast(spark.createDataFrame(ends, "mask int, step int, rank int, sign bigint, here boolean"))

    def signed(value: Column, here: bool = True) -> Column:
        return F.sum(F.when(F.col("here") | F.lit(not here), F.col("sign") * value).otherwise(F.lit(0)))
    ticks = cells.join(steps, "mask").groupBy("part", "step", "rank").agg(
        signed(F.col("docs")).alias("d_removed"), signed(F.col("docs"), False).alias("d_gone"),
        signed(F.col("good")).alias("d_good"), signed(F.col("toxic")).alias("d_toxic"))
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    zero = F.lit(0).cast("bigint")
    turns = {f: F.element_at(F.array(*[F.lit(sum(stop - start for _, own, start, stop in every.get(m, []) if own == f))
                                       for m in range(1 << size)]), F.col("mask") + 1) for f in FILTERS}
    totals = cells.groupBy("part").agg(
        F.sum("docs").alias("all"),
        _by_filter({f: F.when(F.col("mask").bitwiseAND(b) > 0, F.col("docs")).otherwise(zero) for f, b in bit.items()}).alias("fails"),
        _by_filter({f: F.when(F.col("mask") == b, F.col("docs")).otherwise(zero) for f, b in bit.items()}).alias("alone"),
        _by_filter({f: F.col("docs") * turns[f] for f in FILTERS}).alias("shares"))
    grid = totals.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(size)))).withColumn(
        "rank", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))))
    along = Window.partitionBy("part", "step").orderBy("rank")
    sums = grid.join(ticks, ["part", "step", "rank"], "left").withColumns(
        {name: F.sum(F.coalesce(F.col(f"d_{name}"), zero)).over(along) for name in ("removed", "gone", "good", "toxic")})
    order = F.element_at(F.array(*[F.lit(o) for o in orders]), F.col("rank") + 1)
    named = sums.withColumn("filter_order", order).withColumn("own", F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
    of = {name: F.element_at(name, F.col("own")) for name in ("fails", "alone", "shares")}
    return named.select("part", "filter_order", "step", (F.col("all") - F.col("gone")).alias("kept"), "removed",
                        (of["fails"] - F.col("removed")).alias("redundant"), of["alone"].alias("unique_fails"),
                        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), of["shares"].alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return interactions(written(masks(docs, labels, part, text, doc_id), "filter-masks"))
