"""Token ids in ORC files: integer run lengths, row indexes and Bloom filters on document ids.

Documents are cut into ranges of doc_id and sorted inside them before they are
encoded, so only texts move and the files, in the order of their numbers, hold
ascending ids. Each file has stripes that tasks can read on their own. The row
indexes and Bloom filters on ``doc_id`` let a search for documents skip stripes
and row groups; the positions within the whole come from one row of totals per
file and a running sum inside each file.

Defined cases: NULL text counts as empty and holds the end id only. Rows without
a doc_id come first. Rows with one doc_id are ordered by the hash of their text;
repeated rows are equal, so their order does not matter. An empty table gives an
empty result. Extra columns are not written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.llm.common import by_batches
from lamella.llm.tokens import default_vocabulary, encoder

END_ID = 0
SCHEMA = "doc_id bigint, tie bigint, n_tokens bigint, ids array<int>"


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, text: str = "text",
          doc_id: str = "doc_id", stripe_bytes: int = 16 << 20, index_rows: int = 1_000) -> None:
    """Write the ids of every row, the end id last, below ``path`` in ascending order of doc_id."""
    own = vocabulary or default_vocabulary()
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(own)
        ids = [bpe.encode(t) + end for t in batch.column(2).to_pylist()]
        sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), lists],
                                          names=["doc_id", "tie", "n_tokens", "ids"])
    (by_batches(ordered, SCHEMA, run).write.format("orc").option("compression", "lz4")
        .option("orc.stripe.size", str(stripe_bytes)).option("orc.row.index.stride", str(index_rows))
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").save(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written rows. A filter on doc_id reaches the row indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def located(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(3)
        values, ends = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().cumsum()
        raw = memoryview(np.ascontiguousarray(values, dtype="<u4")).cast("B")
        sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        sizes = lists.value_lengths().cast(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), sizes, pa.array(sums, pa.int64())],
                                          names=["file", "doc_id", "tie", "n_tokens", "ids_crc32"])
    rows = read(spark, path).select(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("file"),
                                    "doc_id", "tie", "ids")
    found = by_batches(rows, "file bigint, doc_id bigint, tie bigint, n_tokens bigint, ids_crc32 bigint", run)
    inside = Window.partitionBy("file").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    local = found.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    totals = read(spark, path).select(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("of"), "n_tokens")
    totals = totals.groupBy("of").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    firsts = totals.select("of", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    return local.join(firsts, F.col("file") == F.col("of")).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
