"""Status of every file for every model, its pivot and its export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import numeric, rules, text
from lamella.operators.ordered import first_per_key
from lamella.schemas import NUMERIC_EXPORT_COLUMNS, STATUS_COLUMNS

STATES = ["done", "failed", "pending"]


def fan_out(df: DataFrame, models: Sequence[str] | Column, name: str = "model") -> DataFrame:
    """One row per input row and model; the list is a literal or one value, so nothing is joined or shuffled."""
    return df.withColumn(name, F.explode(models if isinstance(models, Column) else F.array(*[F.lit(m) for m in models])))


def _by_model(rows: DataFrame, models: Sequence[str], value: str, name: str) -> DataFrame:
    """One row per slide with an array holding the value of each model, in list order."""
    cells = [F.max(F.when(F.col("model") == m, F.col(value))) for m in models]
    return rows.where(F.col("model").isin(*models)).groupBy("slide_id").agg(F.array(*cells).alias(name))


def build_status(inventory: DataFrame, models: Sequence[str], results: DataFrame, shards: DataFrame,
                 failures: DataFrame, mpp: DataFrame, now: Column) -> DataFrame:
    """Status rows from the inventory and four lookups.

    ``results``: slide_id, model, path; ``shards``: slide_id, model, wds_path;
    ``failures``: slide_id, reason; ``mpp``: slide_id, native_mpp, mpp_is_fallback.
    Every lookup is first reduced to one row per slide, so all joins share one
    partitioning by slide. Rows are multiplied by model only after the last join.
    """
    models = list(models)
    slides = inventory.withColumn("slide_id", text.slide_id_from_filename(F.col("file_name")))
    joined = (slides
              .join(_by_model(results, models, "path", "_paths"), "slide_id", "left")
              .join(_by_model(shards, models, "wds_path", "_shards"), "slide_id", "left")
              .join(failures.groupBy("slide_id").agg(F.max("reason").alias("_failure")), "slide_id", "left")
              .join(mpp.select("slide_id", "native_mpp", "mpp_is_fallback"), "slide_id", "left"))
    per_model = joined.select("*", F.posexplode(F.array(*[F.lit(m) for m in models])).alias("_i", "model"))
    status, path, reason = rules.status_rule(F.get("_paths", F.col("_i")), F.get("_shards", F.col("_i")), F.col("_failure"))
    return (per_model
            .withColumns({"status": status, "wds_path": path, "failure_reason": reason, "last_updated": now,
                          "tiling_mpp": numeric.tiling_mpp(F.col("native_mpp"), F.col("mpp_is_fallback"))})
            .select(*STATUS_COLUMNS))


def status_pivot(status: DataFrame, by: Sequence[str] = ("project_id", "model")) -> DataFrame:
    """Count per status in columns; conditional counts need no second pass for the value list."""
    return status.groupBy(*by).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATES])


def export_with_inventory(status: DataFrame, inventory: DataFrame,
                          fill: Sequence[str] = ("project_id", "slide_type")) -> DataFrame:
    """Status rows with every inventory column; status wins, blanks in ``fill`` come from the inventory."""
    s, i = status.alias("s"), inventory.alias("i")
    joined = s.join(i, F.col("s.file_id") == F.col("i.file_id"), "left")
    lead = [F.coalesce(text.blank_to_null(F.col(f"s.{c}")), F.col(f"i.{c}")).alias(c)
            if c in fill and c in inventory.columns else F.col(f"s.{c}") for c in status.columns]
    rest = [F.col(f"i.{c}") for c in inventory.columns if c not in status.columns]
    out = joined.select(*lead, *rest)
    typed = {c: numeric.to_number(F.col(c)) for c in NUMERIC_EXPORT_COLUMNS if c in out.columns}
    if "mpp_is_fallback" in out.columns:
        typed["mpp_is_fallback"] = numeric.to_flag(F.col("mpp_is_fallback"))
    return out.withColumns(typed)


def export_from_state(slides: DataFrame, shards: DataFrame, models: Sequence[str] | Column,
                      arrival: Column) -> DataFrame:
    """One row per slide id and model from the state table and the shard manifest.

    The last row per slide id (by ``arrival``) wins. Without ``models`` use
    ``models_or_unknown`` to get the list.
    """
    known = slides.where(F.coalesce(F.col("slide_id"), F.lit("")) != "").withColumn("_arrival", arrival)
    latest = first_per_key(known, ["slide_id"], [F.col("_arrival")], last=True)
    paths = shards.groupBy("slide_id", "model").agg(F.max("wds_path").alias("wds_path"))
    state = F.when(F.col("status").isin("SUCCEEDED", "FAILED"), F.col("status")).otherwise("PENDING")
    rows = fan_out(latest.withColumn("status", state), models).join(paths, ["slide_id", "model"], "left")
    blank = text.null_to_blank
    reason = F.when(F.col("status") == "FAILED", blank(F.col("error_msg"))).otherwise("")
    return rows.select(
        "slide_id", blank(F.col("oncotree_code")).alias("oncotree_code"), "slide_path", "model", "status",
        reason.alias("failure_reason"), blank(F.col("wds_path")).alias("wds_path"), "first_seen_at", "completed_at")


def models_or_unknown(shards: DataFrame, models: Sequence[str] | None) -> Sequence[str] | Column:
    """The given models, else those of the manifest, else 'unknown'.

    The names of the manifest are a scalar subquery: they are found when the export
    runs and never come to the driver's program.
    """
    if models:
        return list(models)
    found = shards.agg(F.sort_array(F.collect_set("model")).alias("models"))
    return found.select(F.when(F.size("models") > 0, F.col("models")).otherwise(F.array(F.lit("unknown")))).scalar()
