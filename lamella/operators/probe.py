"""Linear and bag-level probes on frozen features, with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.operators import metrics
from lamella.operators.embed import pool
from lamella.operators.ordered import with_row_number
from lamella.operators.tiles import HASH_CHUNKS, HASH_RANGE
from lamella.session import stable

# Default search space and seeds of the probes.
C_VALUES = (0.00001, 0.0001, 0.001, 0.01, 0.1, 1.0, 10.0)
ELASTIC_NET = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.5}
RANDOM_STATE = 42
ROWS_PER_TASK = 20_000


def stratified_split(slides: DataFrame, order: Column, test_size: float = 0.2, val_size: float = 0.1,
                     label: str = "label", tie: str = "slide_id") -> DataFrame:
    """Add ``split`` (test, val or train) to one row per slide, with equal shares in every class.

    ``order`` is a hash in [0, 2**32): its ranks within the class decide.
    """
    hashed = slides.withColumn("_h", order)
    chunk = F.floor(F.col("_h") / (HASH_RANGE // HASH_CHUNKS)).cast("int")
    ranked = with_row_number(hashed, [label], ["_h", tie], "_rank", chunk)
    sizes = slides.groupBy(label).agg(F.count("*").alias("_n"))
    n_test = F.round(F.col("_n") * test_size)
    n_val = F.round(F.col("_n") * val_size)
    split = F.when(F.col("_rank") <= n_test, "test").when(F.col("_rank") <= n_test + n_val, "val").otherwise("train")
    return ranked.join(sizes, label, "left").withColumn("split", split).select(*slides.columns, "split")


@dataclass
class ProbeResult:
    """Frames of a probe run; ``values``: seed, split, metric, value."""

    values: DataFrame
    summary: DataFrame
    intervals: DataFrame
    predictions: DataFrame
    report: DataFrame
    cv: DataFrame
    coefficients: DataFrame
    best_params: dict


def _seeded(key: Column, seed: int) -> Column:
    """Uniform in [0, 2**32) from any key."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(HASH_RANGE))


def cross_validate(estimator: Estimator, grid: Sequence[dict], judge, train: DataFrame, folds: int,
                   parallelism: int = 8) -> list[float]:
    """Mean validation metric per grid point; ``train`` has a ``fold`` column.

    Folds are plain filters on the cached rows, so no row passes through Python,
    and fits of different folds and grid points overlap.
    """
    def score(task: tuple[int, dict]) -> float:
        fold, params = task
        model = estimator.fit(train.where(F.col("fold") != fold), params)
        return judge.evaluate(model.transform(train.where(F.col("fold") == fold)))

    # Each task has its own copy of the thread's properties: threads that share one clear each other's execution ids.
    inherit = inheritable_thread_target(train.sparkSession)
    tasks = [inherit(partial(score, (fold, params))) for params in grid for fold in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        scores = pool.map(lambda task: task(), tasks)
    return [sum(scores[i * folds:(i + 1) * folds]) / folds for i in range(len(grid))]


def linear_probe(rows: DataFrame, label: str = "label", group: str = "slide_id", features: str = "features",
                 splits: DataFrame | None = None, c_values: Sequence[float] = C_VALUES,
                 penalties: Sequence[str] = ("l2",), folds: int = 5, seeds: int = 5, replicates: int = 1000,
                 random_state: int = RANDOM_STATE, multiclass: bool = False, max_iter: int = 100,
                 test_size: float = 0.2, val_size: float = 0.2) -> ProbeResult:
    """Grid-searched logistic regression over several seeded splits by group.

    All rows of a group (a slide) fall into the same split and the same fold.
    Training, search and scoring run in Spark ML; the driver holds the grid only.
    """
    spark = rows.sparkSession
    data = rows.select(F.col(group).alias("_unit"), F.col(label).cast("double").alias("label"),
                       array_to_vector(F.col(features)).alias("vector")).persist()
    per_group = data.groupBy("_unit").agg(F.mode("label", True).alias("label"))
    parts, grid_rows, coefficients, best = [], [], [], {}
    number = data.count()
    try:
        for seed in range(random_state, random_state + seeds):
            chosen = splits.select(F.col(group).alias("_unit"), "split") if splits is not None else stratified_split(
                per_group, _seeded(F.col("_unit"), seed), test_size, val_size, tie="_unit").select("_unit", "split")
            fold = F.pmod(F.xxhash64("_unit", F.lit(seed)), F.lit(folds)).cast("int")
            whole = data.join(chosen, "_unit").withColumn("fold", fold)
            # Every iteration is a job over this design: no more tasks than its rows need.
            split = whole.coalesce(max(1, -(-number // ROWS_PER_TASK))).persist()
            train = split.where(F.col("split") == "train")
            n = max(train.count(), 1)
            # The regression standardises by the spread of its training rows itself, each fold by its own, and penalises on that scale.
            regression = LogisticRegression(featuresCol="vector", labelCol="label", maxIter=max_iter, standardization=True)
            grid = (ParamGridBuilder()
                    .addGrid(regression.regParam, [1.0 / (c * n) for c in c_values])
                    .addGrid(regression.elasticNetParam, [ELASTIC_NET[p] for p in penalties]).build())
            judge = (MulticlassClassificationEvaluator(metricName="f1") if multiclass
                     else BinaryClassificationEvaluator(metricName="areaUnderROC"))
            found = cross_validate(regression, grid, judge, train, folds)
            top = max(range(len(grid)), key=lambda i: found[i])
            fitted = regression.fit(train, grid[top])
            for i, params in enumerate(grid):
                grid_rows.append((seed, 1.0 / (params[regression.regParam] * n),
                                  float(params[regression.elasticNetParam]), float(found[i])))
            spread = train.select(Summarizer.std(F.col("vector"))).first()[0]
            weights = fitted.coefficientMatrix.toArray() * spread.toArray()
            coefficients += [(seed, k, j, float(w)) for k, row in enumerate(weights) for j, w in enumerate(row)]
            best.setdefault("C", grid_rows[-len(grid) + top][1])
            best.setdefault("l1_ratio", grid_rows[-len(grid) + top][2])
            best.setdefault("best_cv_auc", grid_rows[-len(grid) + top][3])
            scored = fitted.transform(split.where(F.col("split") != "train")).select(
                F.lit(seed).alias("seed"), "split", "_unit", "label", "prediction", vector_to_array("probability").alias("probabilities"))
            parts.append(stable(scored.withColumn("score", F.col("probabilities")[1])))
            split.unpersist()
        predictions = parts[0]
        for part in parts[1:]:
            predictions = predictions.unionByName(part)
        by = ["seed", "split"]
        if multiclass:
            scored = predictions.withColumn("scores", F.map_from_arrays(
                F.transform(F.sequence(F.lit(0), F.size("probabilities") - 1), lambda i: i.cast("double")),
                F.col("probabilities")))
            frames = {"auc_roc": metrics.ovr_macro_auc(scored, by)}
        else:
            frames = {"auc_roc": metrics.roc_auc(predictions, by),
                      "average_precision": metrics.average_precision(predictions, by),
                      "f1": metrics.binary_f1(predictions, by)}
        report = metrics.class_report(predictions, by)
        values = report.where((F.col("class") == "macro avg") & (F.col("metric") == "f1-score")).select(
            *by, F.lit("macro_f1").alias("metric"), "value")
        for name, frame in frames.items():
            column = [c for c in frame.columns if c not in by][0]
            values = values.unionByName(frame.select(*by, F.lit(name).alias("metric"), F.col(column).alias("value")))
        first_test = predictions.where((F.col("seed") == random_state) & (F.col("split") == "test"))
        intervals = metrics.bootstrap_ci(first_test, [], replicates, random_state)
        summary = metrics.seed_summary(values, ["split", "metric"])
        cv = spark.createDataFrame(grid_rows, "seed int, C double, l1_ratio double, metric double")
        importance = spark.createDataFrame(coefficients, "seed int, class int, dim int, weight double")
        return ProbeResult(values, summary, intervals, predictions, report, cv, importance, best)
    finally:
        data.unpersist()


def bag_probe(tiles: DataFrame, labels: DataFrame, how: str = "mean", **options) -> ProbeResult:
    """Slide-level benchmark: pooled tile features against the slide's binary label.

    ``labels``: slide_id, label and optionally split, which then replaces the
    seeded splits.
    """
    bags = pool(tiles, ["slide_id"], (how,)).join(labels, "slide_id")
    splits = labels.select("slide_id", "split") if "split" in labels.columns else None
    options = {"seeds": 3, "val_size": 0.1, **options}
    return linear_probe(bags, features=f"{how}_features", splits=splits, **options)
