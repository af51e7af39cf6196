"""Packing token sequences by patterns fitted with non-negative least squares.

A document's ids and its end id fill one sequence if they fit; a longer document
is cut so that its first piece is the shorter one and all others fill a sequence.
What is left to pack are pieces shorter than a sequence, at most one per document.

Their lengths make a histogram (at most ``capacity`` numbers, all the driver
sees). Patterns are all sets of two or three lengths that fill a sequence exactly.
Non-negative least squares fits how often to repeat each pattern; rounded counts
take what the histogram holds, and best-fit decreasing packs the residual lengths
(as counts per length and free space). The plan lists, per length, which ranks
go to which sequences. Its size is bounded by the number of patterns, not by the
documents. Pieces are numbered within their length in chunks, so that a length
that holds a third of all rows is not one task, and look their place up.

Defined cases: NULL text counts as empty and is a sequence of one end id.
Repeated rows are packed as often as they occur, also without a doc_id. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, written
from lamella.llm.tokens import default_vocabulary, encoder
from lamella.operators.ordered import with_running_totals

CAPACITY = 1024
END_ID = 2
_CHUNK_ROWS = 200_000
_SHIFT = 44  # ranks within a length stay below 2**44


def bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document with ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first), *[(start, capacity) for start in range(first, n, capacity)]] if n else []


def token_ids(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ``ids`` (little-endian unsigned 32-bit integers, the end id last) of every row."""
    path = vocabulary or default_vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        ids = [own.encode(t) + end for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, "doc_id bigint, ids binary", run)


MEASURES = "doc_id bigint, n_tokens bigint, crcs array<bigint>"


def _measures(doc_id: pa.Array, ids: Iterable[bytes], capacity: int) -> pa.RecordBatch:
    counts, sums = [], []
    for own in ids:
        counts.append(len(own) // 4)
        sums.append([zlib.crc32(own[4 * a:4 * (a + n)]) for a, n in bounds(counts[-1], capacity)])
    return pa.RecordBatch.from_arrays([doc_id, pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
                                      names=["doc_id", "n_tokens", "crcs"])


def measured(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, number of ids, and the crc32 of each piece's ids, with which readers can verify a sequence."""
    return by_batches(tokens.select("doc_id", "ids"), MEASURES,
                      lambda batch: _measures(batch.column(0), batch.column(1).to_pylist(), capacity))


def measured_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                       text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``measured`` of ``token_ids`` in one step: one Python worker per task, and no ids leave it."""
    path = vocabulary or default_vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        return _measures(batch.column(0), (own.encode(t.as_py()) + end for t in batch.column(1)), capacity)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, MEASURES, run)


def patterns(capacity: int) -> np.ndarray:
    """All sets of two or three lengths that fill a sequence; 0 stands for no third piece."""
    two = np.arange(1, capacity // 2 + 1)
    pairs = np.stack([np.zeros_like(two), two, capacity - two], axis=1)
    a, b = np.meshgrid(np.arange(1, capacity // 3 + 1), np.arange(1, capacity), indexing="ij")
    c = capacity - a - b
    fits = (a <= b) & (b <= c)
    return np.concatenate([pairs, np.stack([a[fits], b[fits], c[fits]], axis=1)])


def fit_repeats(sets: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """min |A x - histogram|^2 with x >= 0 by accelerated projected gradient; A counts the lengths of each pattern."""
    size = len(histogram)

    def times(x):
        total = sum(np.bincount(sets[:, k], weights=x, minlength=size) for k in range(sets.shape[1]))
        total[0] = 0
        return total

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[sets].sum(axis=1)
    probe = np.ones(len(sets))
    for _ in range(20):
        probe = back(times(probe))
        probe /= np.linalg.norm(probe) or 1
    step = 1 / (float(probe @ back(times(probe))) * 1.05 or 1)
    x = ahead = np.zeros(len(sets))
    pace = 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - step * back(times(ahead) - histogram), 0)
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead, x, pace = new + (pace - 1) / faster * (new - x), new, faster
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: sequences with equal content are one entry with a count."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(len(left) - 1, 0, -1):
        todo = int(left[length])
        while todo:
            space = min((s for s in free if s >= length), default=None)
            if space is None:
                held, count = (), todo
                space = capacity
            else:
                held, count = free[space].pop()
                if not free[space]:
                    del free[space]
            used = min(count, todo)
            if used < count:
                free.setdefault(space, []).append((held, count - used))
            free.setdefault(space - length, []).append(((*held, length), used))
            todo -= used
    return [entry for entries in free.values() for entry in entries]


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Contents of the sequences and how often each is repeated; all counts of the histogram are used up."""
    left, chosen = histogram.astype(np.int64).copy(), []
    sets = patterns(capacity)
    sets = sets[((histogram[sets] > 0) | (sets == 0)).all(axis=1)]
    if len(sets):
        repeats = fit_repeats(sets, histogram.astype(np.float64))
        for i in np.argsort(-repeats, kind="stable"):
            wanted = int(repeats[i] + 0.5)
            if not wanted:
                break
            lengths = [int(v) for v in sets[i] if v]
            count = min(wanted, *[int(left[v]) // lengths.count(v) for v in lengths])
            if count > 0:
                chosen.append((tuple(reversed(lengths)), count))
                for v in lengths:
                    left[v] -= count
    return chosen + best_fit(left, capacity)


def ranges(contents: list[tuple[tuple[int, ...], int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Per length and first rank (one sorted key): the first sequence and the offset; and the number of sequences."""
    cursor, sequence = np.zeros(size, dtype=np.int64), 0
    keys, first, offsets = [], [], []
    for lengths, count in contents:
        offset = 0
        for length in lengths:
            keys.append((length << _SHIFT) + int(cursor[length]))
            first.append(sequence)
            offsets.append(offset)
            cursor[length] += count
            offset += length
        sequence += count
    order = np.argsort(np.array(keys, dtype=np.int64))
    return (np.array(keys, dtype=np.int64)[order], np.array(first, dtype=np.int64)[order],
            np.array(offsets, dtype=np.int64)[order], sequence)


def pack(measures: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = measures.sparkSession
    rows = written(measures.withColumn("row", F.monotonically_increasing_id()), "lengths")
    rest = F.col("n_tokens") % capacity
    rows = rows.withColumns({"rest": rest, "full": (F.col("n_tokens") - rest) / capacity})
    rows = rows.withColumn("full", F.col("full").cast("bigint"))
    counts = rows.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")).collect()
    histogram, full = np.zeros(capacity, dtype=np.int64), np.zeros(capacity, dtype=np.int64)
    for r in counts:
        histogram[r["rest"]], full[r["rest"]] = r["n"], r["full"]
    chunks = max(int(histogram.sum()) // _CHUNK_ROWS, 1)
    histogram[0] = 0
    keys, first, offsets, number = ranges(plan(histogram, capacity), capacity)
    base = number + np.cumsum(full) - full
    shipped = spark.sparkContext.broadcast((keys, first, offsets, base))  # bounded by the number of patterns
    spread = F.pmod(F.xxhash64("row"), F.lit(1 << 40))
    numbered = with_running_totals(rows.withColumn("spread", spread), ["rest"], ["spread", "row"],
                                   {"rank": F.lit(1).cast("bigint"), "before": "full"},
                                   chunk=F.floor(F.col("spread") * chunks / (1 << 40)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, first, offsets, base = shipped.value
        doc, n, rest, rank, before = (batch.column(i) for i in (0, 1, 3, 4, 5))
        crcs = batch.column(2)
        n, rest, rank, before = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (n, rest, rank, before))
        short = rest > 0
        number = short + (n - rest) // capacity
        owner = np.repeat(np.arange(len(n)), number)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        is_rest = short[owner] & (piece == 0)
        nth = piece - short[owner]
        start = np.where(is_rest, 0, rest[owner] + nth * capacity)
        length = np.where(is_rest, rest[owner], capacity)
        sequence, offset = base[rest[owner]] + before[owner] + nth, np.zeros(len(owner), dtype=np.int64)
        wanted = (rest[owner][is_rest] << _SHIFT) + rank[owner][is_rest]
        at = np.searchsorted(keys, wanted, side="right") - 1
        sequence[is_rest], offset[is_rest] = first[at] + wanted - keys[at], offsets[at]
        columns = [doc.take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), crcs.flatten(),
                   pa.array(sequence), pa.array(offset)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    placed = numbered.select("doc_id", "n_tokens", "crcs", "rest", "rank", "before")
    return by_batches(placed, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint,"
                              " offset bigint", run)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(measured_documents(docs, vocabulary, capacity, end_id), capacity)


def sequences(tokens: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id and ``ids`` of every packed sequence, for unique doc_ids. A sequence is bounded by the capacity."""
    parts = placed.join(tokens, "doc_id").selectExpr(
        "sequence_id", "offset", "substring(ids, cast(1 + 4 * start as int), cast(4 * length as int)) AS ids")
    held = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return held.select("sequence_id", joined.alias("ids"))
