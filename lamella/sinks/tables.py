"""Table, sheet, snapshot and shard sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators import merge, quality
from lamella.session import stable
from lamella.sinks.buckets import BucketTable
from lamella.sources import files, shards
from lamella.sources.files import POINTER


def csv_sink(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; NULL becomes blank."""
    df.write.mode(mode).option("header", True).option("emptyValue", "").csv(path)


def snapshot_sink(df: DataFrame, folder: str, prefix: str = "", now: datetime | None = None) -> str:
    """Write ``<prefix><UTC time>.parquet`` and return its path."""
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S")
    path = f"{folder.rstrip('/')}/{prefix}{stamp}.parquet"
    df.write.parquet(path)
    return path


def replace_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def versioned_sink(df: DataFrame, folder: str, version: int) -> str:
    """Write a table version beside the older ones; readers take the last (``latest_snapshot``).

    The new version may be computed from the one before, and a failed write
    leaves the older versions untouched.
    """
    path = f"{folder.rstrip('/')}/v{version:012d}.parquet"
    df.write.parquet(path)
    return path


def shard_sink(features: DataFrame, assigned: DataFrame, path: str, coords: bool = True, tasks: int | None = None) -> None:
    """Write tile rows as tar shards.

    ``assigned``: model, group, slide_id, shard_file. Packing was done on this
    metadata; the payload joins it here, is gathered by shard and ordered by
    slide and tile within. Shards are numbered first, one row each, and every
    number is a task of its own (with fewer ``tasks``, they share them evenly).
    Spark chooses the join by the measured size of the assignment. Shards that
    exist already are never replaced: the write fails.
    """
    shards.register(features.sparkSession)
    keys = ["model", "group", "shard_file"]
    own = assigned.select(*keys, "slide_id")
    numbers = own.select(*keys).distinct().withColumn("_shard", F.row_number().over(Window.orderBy(*keys)) - 1)
    placed = stable(own.join(numbers, keys))
    last = placed.agg(F.max("_shard")).first()[0]
    if last is None:
        return
    rows = features.join(placed, ["model", "slide_id"])
    for name in ("x", "y"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("bigint"))
    number = min(tasks or last + 1, last + 1)
    (rows.repartitionById(number, (F.col("_shard") % number).cast("int"))
     .select(*keys, "slide_id", "tile_idx", "features", "x", "y", "precision")
     .sortWithinPartitions(*keys, "slide_id", "tile_idx")
     .write.format("tarshards").option("coords", str(coords).lower()).mode("append").save(path))


def index_sink(index: DataFrame, folder: str) -> str:
    """Publish a shard index: written beside the older ones, then named by the pointer file that readers follow.

    The pointer is replaced in one step, so a reader sees the old index or the new one, and what it reads stays where it is.
    """
    spark = index.sparkSession
    name = f"index-{uuid.uuid4().hex[:12]}.parquet"
    index.write.parquet(f"{folder.rstrip('/')}/{name}")
    files.replace_text(spark, f"{folder.rstrip('/')}/{POINTER}", name)
    return name


def manifest_append_sink(entries: DataFrame, path: str, dry_run: bool = False) -> None:
    """Append shard manifest entries; repeated ones are reduced on reading."""
    if not dry_run:
        entries.write.mode("append").option("header", True).csv(path)


def manifest_sink(emitted: Sequence[DataFrame], path: str) -> None:
    """All (slide_id, workflow_id, key, value) emissions as one headerless table."""
    out = emitted[0]
    for frame in emitted[1:]:
        out = out.unionByName(frame)
    out.select("slide_id", "workflow_id", "key", "value").write.mode("overwrite").csv(path)


def merge_sink(source: DataFrame, folder: str, keys: Sequence[str], version: int,
               delete_missing: bool = True, evolve: bool = True) -> DataFrame:
    """Merge into a bucketed Parquet table and return the new version. Only buckets with changes are rewritten."""
    table = BucketTable(source.sparkSession, folder, keys[0])
    if version == 0:
        table.create(merge.merge(source.limit(0), source, keys, delete_missing))
    else:
        table.advance(version, lambda target: merge.merge(target, source, keys, delete_missing, evolve),
                      None if delete_missing else lambda _: source.select(*keys))
    return table.read(version)


def audit_sink(spark, path: str, source_file: str, source_rows: int, target_rows: int, target: str) -> bool:
    """Append one audit row; a failure is reported by the result, never raised."""
    try:
        (spark.range(1).select(F.current_timestamp().alias("run_ts"), F.lit(source_file).alias("source_file"),
                               F.lit(source_rows).cast("bigint").alias("source_rows"),
                               F.lit(target_rows).cast("bigint").alias("target_rows"), F.lit(target).alias("target_table"))
         .write.mode("append").parquet(path))
        return True
    except Exception:
        return False


def written_rows(spark, path: str) -> int:
    """Rows of a written table for the audit, from the Parquet footers alone.

    Not an ``Observation``: once a session has one, models that keep their training
    summary can no longer be sent to executors.
    """
    return spark.read.parquet(path).count()


def sync_status_sink(spark, path: str, ok: bool, message: str, rows: int) -> None:
    (spark.range(1).select(F.lit(ok).alias("ok"), F.lit(message).alias("message"), F.lit(rows).alias("rows"),
                           F.current_timestamp().alias("synced_at"))
     .write.mode("overwrite").json(path))


def samples_sink(samples: DataFrame, sheet_path: str, full_path: str) -> None:
    """The sheet (with lower-case download flags) and the full table beside it."""
    flagged = samples.withColumn("needs_download", F.lower(F.col("needs_download").cast("string")))
    csv_sink(flagged.select("slide_id", "slide_path", "needs_download", "file_id", "file_name"), sheet_path)
    csv_sink(flagged, full_path)


def batch_sheet_sink(sheet: DataFrame, path: str) -> None:
    """One folder per batch; rows of a batch are gathered so that it is few files."""
    (sheet.repartition("batch_id").write.mode("overwrite").partitionBy("batch_id").option("header", True).csv(path))


def prefix_partition_sink(df: DataFrame, path: str, length: int = 4) -> None:
    """Publish under the first characters of the slide id."""
    (df.withColumn("prefix", F.substring("slide_id", 1, length)).write.mode("overwrite")
     .partitionBy("prefix").parquet(path))


def report_tables_sink(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        csv_sink(table, f"{folder.rstrip('/')}/{name}")


def validation_report_sink(errors: DataFrame, path: str) -> None:
    """Error lines as text, in order: the part files of the folder are ranges, and their names follow the order."""
    lines = quality.report_lines(errors)
    lines.repartitionByRange("value").sortWithinPartitions("value").write.mode("overwrite").text(path)


def report_pages(spark, path: str) -> DataFrame:
    """(page, text) of a report written in ordered parts, read back in order: whole parts, so that a page is one file."""
    parts = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("page"), F.col("value").alias("text"))
    return parts.where(F.length("text") > 0).orderBy("page")


def sizes_match(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Written files (key, size) whose listed length differs."""
    return quality.check_sizes(expected, actual).where(F.col("state") != "ok")


