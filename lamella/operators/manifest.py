"""Key/value manifests and shard manifests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import text
from lamella.operators.ordered import first_per_key


def latest_values(rows: DataFrame, keys: Sequence[str], recency: Sequence[Column]) -> DataFrame:
    """Last write per key."""
    return first_per_key(rows, keys, recency, last=True)


def combine_manifests(rows: DataFrame) -> DataFrame:
    """Rows of ``manifest_scan`` reduced to the newest value per (slide_id, key)."""
    newest = latest_values(rows, ["slide_id", "key"], [F.col("modified"), F.col("path"), F.col("line_no")])
    return newest.select("slide_id", "workflow_id", "key", "value")


def manifest_rows(listing: DataFrame, workflow_id: str) -> DataFrame:
    """Manifest rows of result files; paths that are no results are dropped."""
    return (listing.select(
        F.substring_index(text.basename(F.col("path")), ".", 1).alias("slide_id"), F.lit(workflow_id).alias("workflow_id"),
        text.manifest_key(F.col("path")).alias("key"), F.col("path").alias("value"))
        .where(F.col("key").isNotNull()))


def wide(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per (slide, workflow) with a column per key, holding the first value of each."""
    def first_of(key: str) -> Column:
        mine = F.col("key") == key
        return F.min_by(F.when(mine, F.col("value")), F.when(mine, F.struct(*order)))

    return rows.groupBy("slide_id", "workflow_id").agg(*[first_of(k).alias(k) for k in keys])


def unique_slides(manifest: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct slides per model; repeated entries of a slide count once."""
    listed = manifest.where(F.coalesce(F.col("slide_id").cast("string"), F.lit("")) != "")
    count = F.approx_count_distinct("slide_id") if approximate else F.count_distinct("slide_id")
    return listed.groupBy("model").agg(count.alias("n_slides"))


def shard_distribution(manifest: DataFrame) -> DataFrame:
    """Rows per shard, summed up per model."""
    per_shard = manifest.groupBy("model", "wds_path").agg(F.count("*").alias("_n"))
    return per_shard.groupBy("model").agg(
        F.count("*").alias("n_shards"), F.round(F.avg("_n"), 1).alias("avg_rows"),
        F.min("_n").alias("min_rows"), F.max("_n").alias("max_rows"))


def done_counts(manifest: DataFrame, models: Sequence[str], inventory_total: Column | None = None) -> DataFrame:
    """Slides done for every model, two ways.

    ``done_min`` is the smallest per-model count (0 for a model without entries),
    ``done_all`` counts slides that have them all. Both are capped at the total.
    """
    flags = [F.max((F.col("model") == m).cast("int")).alias(f"_has_{i}") for i, m in enumerate(models)]
    per_slide = manifest.where(F.col("model").isin(*models)).groupBy("slide_id").agg(*flags)
    totals = [F.coalesce(F.sum(f"_has_{i}"), F.lit(0)) for i in range(len(models))]
    smallest = F.least(*totals) if len(totals) > 1 else totals[0]
    every = F.count_if(reduce(and_, [F.col(f"_has_{i}") == 1 for i in range(len(models))]))
    if inventory_total is not None:
        smallest, every = F.least(smallest, inventory_total), F.least(every, inventory_total)
    return per_slide.agg(smallest.alias("done_min"), every.alias("done_all"))


def manifest_gap(state: DataFrame, manifest: DataFrame, models: Sequence[str]) -> DataFrame:
    """Per model: succeeded slides without a shard entry."""
    done = state.where(F.col("status") == "SUCCEEDED").select("slide_id").distinct()
    have = (manifest.where(F.col("model").isin(*models)).groupBy("slide_id")
            .agg(F.collect_set("model").alias("_models")))
    joined = done.join(have, "slide_id", "left")
    lacks = [F.count_if(~F.coalesce(F.array_contains("_models", m), F.lit(False))).alias(m) for m in models]
    counts = joined.agg(*lacks)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("n_missing")) for m in models])).alias("_r")).select("_r.*")


def complete_groups(rows: DataFrame, key: str, item: str, expected: str, remainder: bool = False) -> DataFrame:
    """Items of the keys whose expected number has arrived; with ``remainder`` all items, flagged.

    Items stay rows: a group is counted, never gathered, so its size does not matter.
    """
    counts = rows.groupBy(key).agg((F.count_distinct(item) >= F.max(expected)).alias("complete"))
    marked = rows.select(key, item).distinct().join(counts, key)
    return marked if remainder else marked.where("complete").drop("complete")


def grid_attributes(meta: DataFrame, workflow_id: str, paths: Sequence[str] = ()) -> DataFrame:
    """Attributes of tile grids as key/value rows; a missing pixel size reads 'unknown', a missing path is left out."""
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in ("native_mpp", "mpp_is_fallback")}
    cells = [F.struct(F.lit(c).alias("key"), value.alias("value")) for c, value in known.items()]
    cells += [F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in paths]
    rows = meta.select("slide_id", F.lit(workflow_id).alias("workflow_id"), F.explode(F.array(*cells)).alias("_c"))
    return rows.select("slide_id", "workflow_id", "_c.*").where(F.col("value").isNotNull())


def intermediate_models(results: DataFrame, destinations: Sequence[str]) -> DataFrame:
    """Models with result files that are no shard destination, with their number of files. Nothing is deleted."""
    return (results.where(~F.col("model").isin(*destinations)).groupBy("model").agg(F.count("*").alias("n_files")))
