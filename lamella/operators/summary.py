"""Benchmark results of many models side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import numeric, text

# Metric names and report columns of the result files.
PROBE_METRICS = ("tile_auc_roc", "tile_f1", "tile_average_precision")
BAG_METRICS = ("auroc",)
AVERAGE_COLUMNS = ("accuracy", "macro avg", "weighted avg")
PRECISION_SUFFIXES = ("float16", "bfloat16")


def extract_metrics(results: DataFrame, metrics: Sequence[str], splits: Sequence[str] = ("val", "test")) -> DataFrame:
    """Flat metric columns of parsed results: mean and std per split, interval ends for test only."""
    flat = [F.col("model")]
    for split in splits:
        for m in metrics:
            entry = F.col(split)[m]
            flat += [numeric.finite(entry["mean"]).alias(f"{split}_{m}_mean"),
                     numeric.finite(entry["std"]).alias(f"{split}_{m}_std")]
            if split == "test":
                flat += [numeric.finite(F.get(entry["bootstrap_ci_95"], F.lit(i))).alias(f"test_{m}_ci95_{end}")
                         for i, end in enumerate(("lo", "hi"))]
    if "best_params" in results.columns:
        for name in ("C", "penalty"):
            flat.append(F.coalesce(F.col("best_params")[f"clf__{name}"], F.col("best_params")[name]).alias(f"best_{name}"))
    return results.select(*flat)


def benchmark_summary(results: DataFrame, metrics: Sequence[str] = PROBE_METRICS,
                      primary: Sequence[str] = ("test_tile_auc_roc_mean", "test_tile_average_precision_mean")) -> DataFrame:
    """One row per model, best first by the primary metric."""
    flat = extract_metrics(results, metrics)
    ranking = [F.col(c) for c in primary if c in flat.columns] or [F.col(flat.columns[1])]
    lead = ranking[0] if len(ranking) == 1 else F.coalesce(*ranking)
    lo, hi = (f"{primary[0][:-len('_mean')]}_ci95_{end}" for end in ("lo", "hi"))
    if lo in flat.columns:
        down, up = numeric.ci_half_widths(F.col(primary[0]), F.col(lo), F.col(hi))
        flat = flat.withColumns({"ci_down": down, "ci_up": up})
    return flat.orderBy(lead.desc_nulls_last(), "model")


def bag_summary(results: DataFrame) -> DataFrame:
    return benchmark_summary(results, BAG_METRICS, ("test_auroc_mean",))


def per_class_f1(reports: DataFrame) -> DataFrame:
    """F1 per class and model from long reports (model, class, metric, value), in long form."""
    averages = F.col("class").isin(*AVERAGE_COLUMNS)
    return reports.where((F.col("metric") == "f1-score") & ~averages).select(
        "model", "class", F.col("value").alias("f1"))


def per_class_table(reports: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row per model: F1 of each class, accuracy and weighted AUC."""
    def cell(metric: str, column: str):
        return F.max(F.when((F.col("metric") == metric) & (F.col("class") == column), F.col("value")))
    return reports.groupBy("model").agg(
        *[cell("f1-score", c).alias(f"class_{c}_f1") for c in classes],
        cell("accuracy", "accuracy").alias("accuracy"), cell("auc_roc", "weighted avg").alias("weighted_auc"))


def precision_delta(values: DataFrame) -> DataFrame:
    """Variant minus base for every value (model, name, value) of a model that exists in half precision."""
    named = values.withColumns({"base_model": text.base_model(F.col("model")),
                                "precision": text.precision_label(F.col("model"))})
    base = named.where(F.col("precision") == "float32").select("base_model", "name", F.col("value").alias("_base"))
    variant = named.where(F.col("precision") != "float32")
    change = numeric.delta(F.col("value"), F.col("_base"))
    return (variant.join(base, ["base_model", "name"]).select("base_model", "precision", "name", change.alias("delta"))
            .withColumn("band", numeric.delta_band(F.col("delta"))))


def metric_values(results: DataFrame, metrics: Sequence[str] = PROBE_METRICS) -> DataFrame:
    """Flat metric columns in long form (model, name, value) for ``precision_delta``."""
    flat = extract_metrics(results.select("model", "val", "test"), metrics)
    names = [c for c in flat.columns if c != "model"]
    return flat.unpivot("model", names, "name", "value").where(F.col("value").isNotNull())


def report_values(reports: DataFrame) -> DataFrame:
    f1 = per_class_f1(reports)
    return f1.select("model", F.concat(F.lit("class_"), "class", F.lit("_f1")).alias("name"), F.col("f1").alias("value"))


def with_reports(results: DataFrame, reports: DataFrame) -> DataFrame:
    """Results and report of each model together; models lacking either are dropped."""
    gathered = reports.groupBy("model").agg(F.sort_array(F.collect_list(F.struct("class", "metric", "value"))).alias("report"))
    return results.join(gathered, "model")
