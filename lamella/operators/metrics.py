"""Exact ranking metrics, classification reports, curves and bootstrap intervals.

Rows are first reduced to counts per distinct score, which combines before the
shuffle; ordered sums then run over chunks of that table (see ``ordered``).
Frames have a ``label`` (0/1) and a ``score`` unless stated, and ``by`` columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators.ordered import chunked, with_running_totals


def score_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col("label") == 1
    return scored.where(F.col("score").isNotNull() & F.col("label").isNotNull()).groupBy(*by, "score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))


def _with_totals(points: DataFrame, counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Points with the positives and negatives of their group; without groups these are scalar subqueries."""
    if by:
        return points.join(counts.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N")), list(by))
    return points.withColumns({"_P": counts.agg(F.sum("pos")).scalar(), "_N": counts.agg(F.sum("neg")).scalar()})


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank-sum AUC; ties count half. NULL when a class is absent."""
    run = with_running_totals(score_counts(scored, by), by, ["score"], {"_below": "neg"})
    wins = F.sum(F.col("pos").cast("double") * (F.col("_below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return run.groupBy(*by).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def _from_top(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per distinct score, from high to low: true and false positives when cutting there."""
    run = with_running_totals(score_counts(scored, by), by, [F.col("score").desc()], {"_tp": "pos", "_fp": "neg"})
    return run.withColumns({"tp": F.col("_tp") + F.col("pos"), "fp": F.col("_fp") + F.col("neg")}).drop("_tp", "_fp")


def average_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of the recall gained times the precision there."""
    gained = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return _from_top(scored, by).groupBy(*by).agg(
        (gained / F.nullif(F.sum("pos"), F.lit(0))).alias("average_precision"))


def curves(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC and precision-recall points per threshold."""
    points = _with_totals(_from_top(scored, by), score_counts(scored, by), by)
    return points.select(
        *by, F.col("score").alias("threshold"),
        (F.col("fp") / F.nullif(F.col("_N"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("_P"), F.lit(0))).alias("tpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))


def calibration(scored: DataFrame, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean score and share of positives per equal-width score bin over [0, 1]."""
    bin_no = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(*by, bin_no.alias("bin")).agg(
        F.count("*").alias("n"), F.avg("score").alias("mean_score"),
        F.avg((F.col("label") == 1).cast("double")).alias("share_positive"))


def ovr_macro_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean one-vs-rest AUC of rows with a class ``label`` and ``scores`` (map of class to score)."""
    each = scored.select(*by, "label", F.explode("scores").alias("class", "score"))
    binary = each.withColumn("label", (F.col("label") == F.col("class")).cast("int"))
    per_class = roc_auc(binary, [*by, "class"])
    return per_class.groupBy(*by).agg(F.avg("roc_auc").alias("roc_auc_macro"))


def confusion(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per (label, prediction)."""
    return predicted.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(predicted: DataFrame, classes: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """One row per label with a column per predicted class."""
    return predicted.groupBy(*by, "label").agg(*[
        F.count_if(F.col("prediction") == c).alias(f"pred_{c}") for c in classes])


def class_report(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages, in long form."""
    cells = confusion(predicted, by)
    sides = cells.select(*by, F.explode(F.array(
        F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("hits")))).alias("_s")).select(*by, "_s.*")
    zero = F.lit(0.0)
    per_class = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    precision = F.coalesce(F.col("hits") / F.nullif(F.col("claimed"), F.lit(0)), zero)
    recall = F.coalesce(F.col("hits") / F.nullif(F.col("support"), F.lit(0)), zero)
    f1 = F.coalesce(F.lit(2.0) * F.col("hits") / F.nullif(F.col("claimed") + F.col("support"), F.lit(0)), zero)
    per_class = per_class.withColumns({"precision": precision, "recall": recall, "f1-score": f1})
    names = ["precision", "recall", "f1-score"]
    weighted = [(F.sum(F.col(f"`{n}`") * F.col("support")) / F.sum("support")).alias(f"w_{n}") for n in names]
    overall = per_class.groupBy(*by).agg(
        *[F.avg(F.col(f"`{n}`")).alias(f"m_{n}") for n in names], *weighted,
        (F.sum("hits") / F.sum("support")).alias("accuracy"), F.sum("support").cast("double").alias("total"))

    def rows(prefix: str, name: str) -> list:
        return [F.struct(F.lit(name).alias("class"), F.lit(n).alias("metric"), F.col(f"`{prefix}{n}`").alias("value"))
                for n in names]

    long = per_class.select(*by, F.explode(F.array(
        *[F.struct(F.col("class"), F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n in names],
        F.struct(F.col("class"), F.lit("support").alias("metric"), F.col("support").cast("double").alias("value"))
    )).alias("_r"))
    averages = overall.select(*by, F.explode(F.array(
        *rows("m_", "macro avg"), *rows("w_", "weighted avg"),
        *[F.struct(F.lit(c).alias("class"), F.lit("support").alias("metric"), F.col("total").alias("value"))
          for c in ("macro avg", "weighted avg")],
        F.struct(F.lit("accuracy").alias("class"), F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    )).alias("_r"))
    return long.unionByName(averages).select(*by, "_r.*")


def binary_f1(scored: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    claimed, real = F.col("score") >= threshold, F.col("label") == 1
    return scored.groupBy(*by).agg(F.coalesce(
        F.lit(2.0) * F.count_if(claimed & real) / F.nullif(F.count_if(claimed) + F.count_if(real), F.lit(0)),
        F.lit(0.0)).alias("f1"))


def seed_summary(values: DataFrame, by: Sequence[str] = ("model", "split", "metric")) -> DataFrame:
    """Mean and population standard deviation over seeds."""
    return values.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def bootstrap_ci(scored: DataFrame, by: Sequence[str] = (), replicates: int = 1000, seed: int = 42, block: int = 50) -> DataFrame:
    """95 % bootstrap intervals of AUC, average precision and F1 (cut at 0.5), on the exact scores.

    Resampling with Poisson(1) weights: the weights of n equal rows add up to
    Poisson(n), so one draw per distinct score and replicate does. The scores are
    cut into ordered chunks; a task holds one chunk and one block of replicates.
    A first pass sums the draws of each chunk, a second repeats them (same seed)
    with the sums of the chunks below, so no task holds a whole group.
    """
    parts = chunked(score_counts(scored, by), by, ["score"]).withColumn("_key", F.to_json("__group"))
    blocks = -(-replicates // block)
    rows = parts.select("_key", F.col("__chunk").alias("_chunk"), "score", "pos", "neg",
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    keys = ["_key", "_chunk", "_block"]

    def draws(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
        frame = frame.sort_values("score")
        number, chunk = int(frame["_block"].iat[0]), int(frame["_chunk"].iat[0])
        which = np.arange(number * block, min((number + 1) * block, replicates))
        rng = np.random.default_rng([seed, number, chunk, zlib.crc32(frame["_key"].iat[0].encode())])
        pos, neg = (rng.poisson(frame[c].to_numpy()[:, None], (len(frame), len(which))) for c in ("pos", "neg"))
        return frame, which, pos, neg

    def totals(frame: pd.DataFrame) -> pd.DataFrame:
        frame, which, pos, neg = draws(frame)
        return pd.DataFrame({"_key": frame["_key"].iat[0], "_chunk": frame["_chunk"].iat[0], "_block": frame["_block"].iat[0],
                             "replicate": which, "pos": pos.sum(0), "neg": neg.sum(0)})

    sums = rows.groupBy(*keys).applyInPandas(totals, "_key string, _chunk int, _block int, replicate int, pos bigint, neg bigint")
    every = Window.partitionBy("_key", "replicate")
    below = every.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.select(*keys, "replicate", *[F.sum(c).over(every).alias(f"all_{c}") for c in ("pos", "neg")],
                        *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"below_{c}") for c in ("pos", "neg")])

    def partial(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        frame, which, pos, neg = draws(frame)
        known = known.set_index("replicate").loc[which]
        all_pos, all_neg, below_pos, below_neg = (known[c].to_numpy() for c in ("all_pos", "all_neg", "below_pos", "below_neg"))
        under_pos, under_neg = np.cumsum(pos, 0) - pos + below_pos, np.cumsum(neg, 0) - neg + below_neg
        tp, fp = all_pos - under_pos, all_neg - under_neg
        cut = frame["score"].to_numpy() >= 0.5
        return pd.DataFrame({"_key": frame["_key"].iat[0], "replicate": which, "all_pos": all_pos, "all_neg": all_neg,
                             "wins": (pos * (under_neg + neg / 2)).sum(0), "gained": (pos * tp / np.maximum(tp + fp, 1)).sum(0),
                             "tp": pos[cut].sum(0), "fp": neg[cut].sum(0)})

    found = rows.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInPandas(
        partial, "_key string, replicate int, all_pos bigint, all_neg bigint, wins double, gained double, tp bigint, fp bigint")
    whole = found.groupBy("_key", "replicate").agg(F.max("all_pos").alias("P"), F.max("all_neg").alias("N"),
                                                   *[F.sum(c).alias(c) for c in ("wins", "gained", "tp", "fp")])
    values = whole.select("_key", F.explode(F.create_map(
        F.lit("roc_auc"), F.col("wins") / F.nullif(F.col("P").cast("double") * F.col("N"), F.lit(0.0)),
        F.lit("average_precision"), F.col("gained") / F.nullif(F.col("P"), F.lit(0)),
        F.lit("f1"), F.coalesce(F.lit(2.0) * F.col("tp") / F.nullif(F.col("tp") + F.col("fp") + F.col("P"), F.lit(0)), F.lit(0.0)))
    ).alias("metric", "value")).where(F.col("value").isNotNull())
    ends = F.percentile("value", F.array(F.lit(0.025), F.lit(0.975)))
    named = values.groupBy("_key", "metric").agg(ends.alias("_ci")).join(parts.select("_key", *by).distinct(), "_key")
    return named.select(*by, "metric", F.col("_ci")[0].alias("ci_lo"), F.col("_ci")[1].alias("ci_hi"))
