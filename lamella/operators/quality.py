"""Checks that split rows into good ones and reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import predicates


def check_sheet(rows: DataFrame) -> DataFrame:
    """Sheet rows with ``reasons``; an empty list means valid."""
    return rows.withColumn("reasons", predicates.sheet_reasons(F.col("slide_id"), F.col("slide_path")))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0))


def check_manifest(manifest: DataFrame, listing: DataFrame, tiles: DataFrame, features: DataFrame) -> DataFrame:
    """Errors of manifest entries (slide_id, key, value): missing file, grid without tiles, no features."""
    files = listing.select(F.col("path").alias("value")).distinct().withColumn("_file", F.lit(True))
    grids = tiles.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select("slide_id").distinct().withColumn("_grid", F.lit(True))
    loaded = features.where(F.size("features") > 0).select("slide_id").distinct().withColumn("_loaded", F.lit(True))
    joined = (manifest.join(files, "value", "left").join(grids, "slide_id", "left").join(loaded, "slide_id", "left"))
    error = (F.when(F.col("_file").isNull(), "file missing")
             .when(F.col("key").endswith("tiles_h5_path") & F.col("_grid").isNull(), "no coords")
             .when(F.col("key").endswith("_features_tensor_path") & F.col("_loaded").isNull(), "no features"))
    return joined.withColumn("error", error).where(F.col("error").isNotNull()).select("slide_id", "key", "value", "error")


def check_shards(members: DataFrame) -> DataFrame:
    """Shards (shard, member) without members or without a feature entry."""
    per_shard = members.groupBy("shard").agg(
        F.count("member").alias("n_members"),
        F.count_if(F.col("member").endswith(".features.npy")).alias("n_features"))
    error = F.when(F.col("n_members") == 0, "empty shard").when(F.col("n_features") == 0, "no feature entry")
    return per_shard.withColumn("error", error)


def check_sizes(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Files (key, size) against a listing (key, length): missing, partial or ok; size 0 is unknown."""
    found = listing.groupBy("key").agg(F.max("length").alias("length"))
    size = F.coalesce(F.col("size"), F.lit(0))
    state = (F.when(F.col("length").isNull(), "missing")
             .when((size == 0) | (F.col("length") == size), "ok").otherwise("partial"))
    return expected.join(found, "key", "left").withColumn("state", state)


def require_columns(df: DataFrame, required: Sequence[str], exact: bool = False) -> DataFrame:
    """The frame itself, or an error when its columns break the contract."""
    missing = [c for c in required if c not in df.columns]
    if missing or (exact and list(df.columns) != list(required)):
        raise ValueError(f"expected the columns {list(required)}, found {df.columns}")
    return df


def split_errors(results: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that worked and rows recorded as failed; one bad element never stops the rest."""
    return results.where(F.col(error).isNull()).drop(error), results.where(F.col(error).isNotNull())


def report_lines(errors: DataFrame) -> DataFrame:
    """Error rows as text lines for the validation report."""
    return errors.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in errors.columns]).alias("value"))
