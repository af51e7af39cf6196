"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.session import scratch_dir

#: White space of the word rules: the blank and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
BATCH_ROWS = 1_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs see these rows, also after a lost executor."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to Arrow batches of at most ``BATCH_ROWS`` rows: texts are long, and a task holds a batch several times."""
    if int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def by_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``mapInArrow`` of a function from one batch to one batch with the given DDL schema."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return in_small_batches(df).mapInArrow(run, schema)


def portions(texts: Sequence[str | None], limit: int = 1_000_000) -> Iterable[tuple[int, int]]:
    """Bounds of runs of texts with about ``limit`` characters each (a longer text is a run of its own)."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size + 1
    if start < len(texts):
        yield start, len(texts)


def fold(of: str, parts: int) -> Column:
    """``crc32`` of the id's text modulo ``parts``; a NULL id falls into part 0."""
    return F.coalesce(F.crc32(F.col(of).cast("string").cast("binary")) % parts, F.lit(0))


def with_row_keys(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The columns of ``docs`` by number (which no input name clashes with), row_id, row_text and row_hash (of all columns but maps)."""
    numbered = docs.toDF(*[f"in_{i}" for i in range(len(docs.columns))])
    whole = [f.name for f in numbered.schema.fields if "map<" not in f.dataType.simpleString()]
    nulls = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in whole])
    at = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    keyed = numbered.withColumns({"row_id": F.col(at[doc_id]).cast("bigint"), "row_text": F.col(at[text]).cast("string"),
                                  "row_hash": F.xxhash64(*whole, nulls)})
    return keyed.withMetadata("row_id", {"names": docs.columns})


def one_per_group(keyed: DataFrame, groups: DataFrame, body: Column) -> DataFrame:
    """Of rows ``with_row_keys``, one per ``grp``, where ``groups`` gives the grp of each ``body``: the smallest id, NULL last, then by hash.

    A row is named by id, body and hash. Rows equal in all three are one row.
    """
    rows = keyed.select("row_id", "row_hash", body.alias("body"))
    order = F.struct(F.col("row_id").isNull().alias("last"), "row_id", "body", "row_hash")
    chosen = rows.join(groups, "body").groupBy("grp").agg(F.min(order).alias("c")).select(
        F.coalesce("c.row_id", F.lit(0)).alias("c_id"), F.col("c.last").alias("c_last"), F.col("c.body").alias("c_body"), F.col("c.row_hash").alias("c_hash"))
    keys = {"c_id": F.coalesce("row_id", F.lit(0)), "c_last": F.col("row_id").isNull(), "c_body": body, "c_hash": F.col("row_hash")}
    kept = keyed.withColumns(keys).join(chosen, list(keys), "left_semi").dropDuplicates(list(keys))
    names = keyed.schema["row_id"].metadata["names"]
    return kept.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(names)])
