"""Importance resampling towards a target text, on hashed word runs from prefix CRCs.

A document is put into plain form (A-Z in lower case, separators as one blank) and
scanned once: the running CRC-32 after each word is all that is kept of it. CRC-32
is linear over GF(2), so that ``crc(AB) = shift(crc(A), len(B)) ^ crc(B)``, where
``shift`` appends zero bytes. The CRC of any run of words is therefore the running
CRC at its end with the one at its start, shifted by the length of the run,
cancelled out of it. Runs of every length come from the same two columns of numbers.

The feature of a run is its CRC modulo ``BUCKETS``. Counts over all documents and
over the target give each bucket a gain, the logarithm of its smoothed ratio; a
document's weight is the sum over its features. A part of the documents is drawn
without replacement by adding to each weight a Gumbel number made from the id.

How it scales: texts are read once; their buckets (two bytes per feature) are
written and read for the counts and the weights. Each task gives at most one row per
bucket to the counts. The driver sees ``BUCKETS`` counts, which bounds what is sent
to the tasks. Ranks come from a range partitioning of 40 bytes per document.

Defined cases: NULL text has no words, and weight 0. Documents of under ``MIN_WORDS``
words are scored, not drawn. Rows with one doc_id are rows of their own; equal scores
are ranked by doc_id, equal ids by their other results. Rows without a doc_id draw
with the empty text as id and stand before others of the same score. An empty target
or an empty table gives counts of zero. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, in_small_batches, portions, written
from lamella.operators.ordered import with_row_number

BUCKETS = 10_000
RUN = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_PLAIN = bytes(0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Lengths of runs below 2 ** LENGTH_BITS bytes; Spark's strings are shorter.
LENGTH_BITS = 32


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


def zero_tables() -> np.ndarray:
    """``[k, j, b]``: a CRC whose only set byte is ``b`` at place ``j``, after 2 ** k more zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ 0xEDB88320, byte >> 1).astype(np.uint32)
    start = np.arange(256, dtype=np.uint32)[None] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    tables = [byte[start & 0xFF] ^ start >> 8]
    for _ in range(LENGTH_BITS - 1):
        tables.append(_applied(tables[-1], tables[-1]))
    return np.stack(tables)


def _applied(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> 8 & 0xFF] ^ table[2][crc >> 16 & 0xFF] ^ table[3][crc >> 24]


def shifted(tables: np.ndarray, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC as after ``length`` more zero bytes: one step per bit of the lengths."""
    out = crc.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> k & 1)
        out[at] = _applied(tables[k], out[at])
    return out


def scanned(words: list[bytes]) -> list[int]:
    """The running CRC of the plain form after each word."""
    crc, held, out = zlib.crc32, 0, []
    for word in words:
        held = crc(word, crc(b" ", held)) if out else crc(word)
        out.append(held)
    return out


def running(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of all documents: CRC after the word before, CRC after it, and its first and last place in the plain form."""
    counts = np.array([len(words) for words in documents], dtype=np.int64)
    after = np.fromiter((crc for words in documents for crc in scanned(words)), dtype=np.uint32, count=int(counts.sum()))
    sizes = np.fromiter((len(w) + 1 for words in documents for w in words), dtype=np.int64, count=len(after))
    first = (np.cumsum(counts) - counts)[counts > 0]
    before, upto = np.roll(after, 1), np.cumsum(sizes)
    before[first] = 0
    end = upto - np.repeat((upto - sizes)[first], counts[counts > 0]) - 1
    return before, after, end - (sizes - 1), end


def run_crcs(documents: list[list[bytes]], tables: np.ndarray, longest: int = RUN) -> list[np.ndarray]:
    """CRCs of all runs of 1 to ``longest`` words of each document, joined by one blank, shorter runs first."""
    counts = np.array([len(words) for words in documents], dtype=np.int64)
    before, after, start, end = running(documents)
    # Before a word, other than the first, its blank has passed, too.
    begun = np.where(start > 0, _applied(tables[0], before) ^ np.uint32(zlib.crc32(b" ")), before)
    inside = np.arange(len(start)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - inside
    owner = np.repeat(np.arange(len(counts)), counts)
    found, owners = [], []
    for n in range(1, longest + 1):
        at = np.flatnonzero(left >= n)
        last = at + n - 1
        found.append(after[last] ^ shifted(tables, begun[at], end[last] - start[at]))
        owners.append(owner[at])
    values, whose = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    per_doc = np.bincount(whose, minlength=len(counts))
    return np.split(values[order], np.cumsum(per_doc)[:-1]) if len(counts) else []


def features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", longest: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and held (the bucket of each feature, 2 or 4 bytes each) of every row."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = zero_tables()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words, held = [], []
            for a, b in portions(texts):
                documents = [plain_words(t) for t in texts[a:b]]
                words += map(len, documents)
                held += [(crcs % buckets).astype(kind).tobytes() for crcs in run_crcs(documents, tables, longest)]
            sizes = [len(x) // np.dtype(kind).itemsize for x in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(held, pa.binary())],
                                             names=["doc_id", "n_words", "n_features", "held"])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return in_small_batches(rows).mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, held binary")


def bucket_counts(held: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs. A task counts its rows before anything is shuffled."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])
    rows = held.select("held").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: floor of 1000 times the logarithm of its smoothed share in the target over that in the documents."""
    s_all, t_all, size = float(raw.sum()), float(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + size) / ((float(s) + 1) * (t_all + size))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def weights(held: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of ``features``."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = [int(gain[np.frombuffer(v.as_buffer(), kind)].sum()) for v in batch.column(3)]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])
    return by_batches(held, "doc_id bigint, n_words bigint, n_features bigint, weight bigint", run)


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", longest: int = RUN, buckets: int = BUCKETS,
             seed: int = SEED, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (NULL if not drawn) of every row."""
    held = written(features(docs, text, doc_id, longest, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), F.col(text).alias("text")), longest=longest, buckets=buckets)
    gain = gains(bucket_counts(held, buckets), bucket_counts(wanted, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weights(held, gain).withColumn("score", F.col("weight") + noise).withColumn("enough", F.col("n_words") >= min_words)
    scored = written(scored, "scored")
    drawn = percent * scored.filter("enough").count() // 100
    order = [F.desc("enough"), F.desc("score"), F.col("doc_id"), F.col("weight"), F.col("n_features"), F.col("n_words")]
    placed = with_row_number(scored, [], order, "place")
    rank = F.when(F.col("enough") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
