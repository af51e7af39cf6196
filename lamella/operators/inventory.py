"""Dated inventory: flattening fetched documents, merging snapshots, looking back in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import nested, predicates, text
from lamella.operators.ordered import first_per_key
from lamella.schemas import FETCHED_COLUMNS


def flatten_hits(hits: DataFrame) -> DataFrame:
    """Nested file documents as flat rows, one per ``file_id`` (the first by content order)."""
    case = nested.first_element(F.col("cases"))
    sample = nested.first_element(F.col("_case.samples"))
    portion = nested.first_element(F.col("_sample.portions"))
    slide = nested.first_element(F.col("_portion.slides"))
    opened = (hits.withColumn("_case", case).withColumn("_sample", sample)
              .withColumn("_portion", portion).withColumn("_slide", slide))
    diagnoses = F.col("_case.diagnoses")
    source = {"slide_type": text.slide_type(F.col("file_name")), "case_submitter_id": F.col("_case.submitter_id")}
    source |= {c: F.col(c) for c in ("file_id", "file_name", "file_size", "md5sum", "updated_datetime")}
    source |= {c: F.col(f"_case.project.{c}") for c in ("project_id", "primary_site", "disease_type")}
    source |= {c: F.col(f"_case.demographic.{c}")
               for c in ("gender", "age_at_index", "vital_status", "race", "ethnicity")}
    source |= {c: nested.first_value(diagnoses, c)
               for c in ("primary_diagnosis", "morphology", "ajcc_pathologic_stage", "tumor_grade")}
    source |= {c: F.col(f"_sample.{c}") for c in ("sample_type", "tissue_type", "tumor_descriptor")}
    source |= {c: F.col(f"_slide.{c}") for c in ("section_location", "percent_tumor_cells", "percent_stromal_cells",
                                                 "percent_necrosis", "percent_normal_cells")}
    flat = opened.select(*[source[c].alias(c) for c in FETCHED_COLUMNS])
    return first_per_key(flat, ["file_id"], [F.col("file_name"), F.col("md5sum")])


def scd_merge(old: DataFrame, new: DataFrame, sync_date: Column, key: str = "file_id",
              version: str = "updated_datetime") -> DataFrame:
    """Merge a fresh snapshot into the dated inventory in one full outer join.

    Adds ``change``: added, removed (newly), updated, reappeared or unchanged.
    A row gone from the snapshot keeps its data and is stamped once; a row that
    comes back loses its stamp and keeps its first date.
    """
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    in_old, in_new = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    gone_before = F.col("o.removed_date").isNotNull()
    changed = ~F.col(f"o.{version}").eqNullSafe(F.col(f"n.{version}"))
    data = [F.when(in_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in new.columns]
    change = (F.when(~in_old, "added")
              .when(~in_new & ~gone_before, "removed")
              .when(~in_new, "unchanged")
              .when(changed, "updated")
              .when(gone_before, "reappeared")
              .otherwise("unchanged"))
    return joined.select(
        *data,
        F.when(in_old, F.col("o.first_seen_date")).otherwise(sync_date).alias("first_seen_date"),
        F.when(~in_new, F.coalesce(F.col("o.removed_date"), sync_date)).alias("removed_date"),
        change.alias("change"))


def change_counts(merged: DataFrame) -> DataFrame:
    """One row: how many rows were added, removed and updated, and how many are active."""
    return merged.agg(
        F.count_if(F.col("change") == "added").alias("n_added"),
        F.count_if(F.col("change") == "removed").alias("n_removed"),
        F.count_if(F.col("change") == "updated").alias("n_updated"),
        F.count_if(predicates.active(F.col("removed_date"))).alias("n_active"))


def first_inventory(new: DataFrame, sync_date: Column) -> DataFrame:
    return new.withColumn("first_seen_date", sync_date).withColumn("removed_date", F.lit(None).cast("date"))


def backfill_temporal(old: DataFrame) -> DataFrame:
    """Add the two date columns to an inventory written before they existed."""
    for name in ("first_seen_date", "removed_date"):
        if name not in old.columns:
            old = old.withColumn(name, F.lit(None).cast("date"))
    return old


def snapshot_at(inventory: DataFrame, at: Column) -> DataFrame:
    return inventory.where(predicates.present_at(F.col("first_seen_date"), F.col("removed_date"), at))


def new_since(inventory: DataFrame, date: Column) -> DataFrame:
    return inventory.where(F.col("first_seen_date") == date)


def unchanged_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in both snapshots."""
    return old.select(*keys).intersect(new.select(*keys))
