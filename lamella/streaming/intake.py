"""Streams of arriving files, sheets and rows, and the stateless or built-in-state steps on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella import schemas
from lamella.functions import predicates, text

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, root: str, extensions: Sequence[str], min_bytes: int = 0,
                max_files: int = 10_000) -> DataFrame:
    """New files below ``root``, by listing only: (path, length, modified, slide_id)."""
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files).load(root)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    ok = (predicates.allowed_extension(F.col("path"), extensions) & predicates.settled_name(F.col("path"))
          & predicates.min_size(F.col("length"), min_bytes))
    return files.where(ok).withColumn("slide_id", text.stem(F.col("path")))


def sheet_stream(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Rows of sheets as they appear, with the sheet they came from."""
    return (spark.readStream.schema(schemas.SAMPLES).option("header", True).option("pathGlobFilter", pattern)
            .csv(folder).withColumn("sheet", F.col("_metadata.file_path")))


def with_sheet_sizes(batch: DataFrame) -> DataFrame:
    """Rows with the number of slides of their sample in their own sheet; for ``foreachBatch``."""
    named = batch.withColumn("sample_id", F.coalesce("sample_id", "slide_id"))
    sizes = named.groupBy("sheet", "sample_id").agg(F.count("*").alias("n_slides"))
    return named.join(sizes, ["sheet", "sample_id"])


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """A Parquet file in a folder of several, read as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def known_once(stream: DataFrame, keys: Sequence[str] = ("slide_path",), event_time: str | None = None,
               within: str | None = None) -> DataFrame:
    """Each key once: for ever, or within a time span so that the state stays bounded."""
    if event_time and within:
        return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def throughput_windows(stream: DataFrame, at: str, late: str, window: str = "6 hours", slide: str | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    """Completions per event-time window. Rows that come later than ``late`` behind the newest are not counted."""
    frame = F.window(at, window, slide) if slide else F.window(at, window)
    return (stream.withWatermark(at, late).groupBy(frame.alias("window"), *by)
            .agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")))
