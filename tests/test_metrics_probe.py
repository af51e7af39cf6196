import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella import schemas
from lamella.functions import numeric
from lamella.operators import metrics, probe, summary
from tests.conftest import rows


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    data = []
    for model in ("a", "b"):
        for _ in range(300):
            label = int(rng.random() < 0.4)
            data.append((model, label, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * label, 0.2))), 2)))
    return spark.createDataFrame(data, "model string, label int, score double"), data


def _auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


def _ap(pairs):
    total = sum(y for y, _ in pairs)
    out, before = 0.0, 0
    for cut in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(y for y, s in pairs if s >= cut)
        out += (tp - before) / total * tp / sum(1 for _, s in pairs if s >= cut)
        before = tp
    return out


def test_auc_and_ap_equal_definition(scored):
    df, data = scored
    auc, ap = dict(rows(metrics.roc_auc(df, ["model"]))), dict(rows(metrics.average_precision(df, ["model"])))
    for model in "ab":
        mine = [(y, s) for m, y, s in data if m == model]
        assert auc[model] == pytest.approx(_auc(mine)) and ap[model] == pytest.approx(_ap(mine))
    assert metrics.roc_auc(df).first()[0] == pytest.approx(_auc([(y, s) for _, y, s in data]))


def test_auc_of_one_class_is_null(scored):
    assert metrics.roc_auc(scored[0].where("label = 1")).first()[0] is None


def test_curves_end_at_one(scored):
    last = metrics.curves(scored[0], ["model"]).orderBy("threshold").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)
    bins = metrics.calibration(scored[0], 10).collect()
    assert sum(r.n for r in bins) == 600 and max(r.bin for r in bins) <= 9


def test_report_equals_definition(spark):
    rng = random.Random(2)
    data = [(rng.randint(0, 3), rng.choice([0, 1, 2, 5])) for _ in range(200)]
    df = spark.createDataFrame(data, "label int, prediction int")
    got = {(r["class"], r.metric): r.value for r in metrics.class_report(df).collect()}
    for c in (0, 1, 2, 3, 5):
        tp = sum(y == p == c for y, p in data)
        claimed, support = sum(p == c for _, p in data), sum(y == c for y, _ in data)
        assert got[str(c), "precision"] == pytest.approx(tp / claimed if claimed else 0)
        assert got[str(c), "recall"] == pytest.approx(tp / support if support else 0)
        assert got[str(c), "support"] == support
    assert got["accuracy", "accuracy"] == pytest.approx(sum(y == p for y, p in data) / 200)
    assert got["macro avg", "f1-score"] == pytest.approx(np.mean([got[str(c), "f1-score"] for c in (0, 1, 2, 3, 5)]))


def test_macro_auc(spark):
    df = spark.createDataFrame([(0, {0: 0.9, 1: 0.1}), (1, {0: 0.2, 1: 0.8}), (0, {0: 0.4, 1: 0.6})], "label int, scores map<int,double>")
    assert metrics.ovr_macro_auc(df).first()[0] == pytest.approx(1.0)


def test_bootstrap_brackets_and_repeats(scored):
    df, data = scored
    one = {(r.model, r.metric): (r.ci_lo, r.ci_hi) for r in metrics.bootstrap_ci(df, ["model"], 300).collect()}
    two = {(r.model, r.metric): (r.ci_lo, r.ci_hi) for r in metrics.bootstrap_ci(df.repartition(3), ["model"], 300).collect()}
    assert one == two
    for model in "ab":
        auc = _auc([(y, s) for m, y, s in data if m == model])
        lo, hi = one[model, "roc_auc"]
        assert lo < auc < hi and hi - lo == pytest.approx(2 * 1.96 * 0.032, rel=0.35)


def test_bootstrap_uses_exact_scores(spark):
    """Scores just below the cut are negatives of F1, and close scores are no ties."""
    data = [(1, 0.49996 + i * 1e-7) for i in range(50)] + [(0, 0.4 + i * 1e-7) for i in range(50)]
    got = {r.metric: (r.ci_lo, r.ci_hi) for r in metrics.bootstrap_ci(spark.createDataFrame(data, "label int, score double"), [], 100).collect()}
    assert got == {"f1": (0.0, 0.0), "roc_auc": (1.0, 1.0), "average_precision": (1.0, 1.0)}


def test_split_is_stratified_and_seeded(spark):
    slides = spark.range(200).select(F.col("id").alias("slide_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    out = probe.stratified_split(slides, numeric.portable_hash(F.col("slide_id"), seed=3))
    counts = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert counts == {(0, "test"): 30, (0, "val"): 15, (0, "train"): 105, (1, "test"): 10, (1, "val"): 5, (1, "train"): 35}
    again = probe.stratified_split(slides.repartition(5), numeric.portable_hash(F.col("slide_id"), seed=3))
    assert rows(out) == rows(again)


@pytest.fixture(scope="module")
def probe_tiles(spark):
    """Twenty slides of ten tiles with eight values, positives around +1, negatives around -1."""
    rng = np.random.default_rng(42)
    data = [(s, t, int(t < (7 if s < 10 else 3)), [float(v) for v in rng.normal(1 if t < (7 if s < 10 else 3) else -1, 1, 8)])
            for s in range(20) for t in range(10)]
    return spark.createDataFrame(data, "slide_id int, tile_idx int, label int, features array<double>")


def test_linear_probe(probe_tiles):
    result = probe.linear_probe(probe_tiles, c_values=(0.1, 1.0), folds=2, seeds=1, replicates=100, max_iter=15)
    got = {(r.split, r.metric): r.mean for r in result.summary.collect()}
    assert got["test", "auc_roc"] > 0.95 and 0 <= got["val", "f1"] <= 1
    assert result.cv.count() == 2 and result.coefficients.count() == 8
    assert all(r.ci_lo <= r.ci_hi for r in result.intervals.collect())
    splits = result.predictions.groupBy("_unit").agg(F.count_distinct("split").alias("n"))
    assert splits.where("n > 1").count() == 0
    assert result.best_params["C"] == pytest.approx(0.1) or result.best_params["C"] == pytest.approx(1.0)


def test_bag_probe_with_given_split(spark, probe_tiles):
    labels = spark.createDataFrame([(s, int(s < 10), ("train", "train", "val", "test")[s % 4]) for s in range(20)], "slide_id int, label int, split string")
    result = probe.bag_probe(probe_tiles, labels, c_values=(1.0,), folds=2, seeds=1, replicates=50, max_iter=10)
    assert {r.split for r in result.summary.collect()} == {"val", "test"}
    assert result.predictions.where("split = 'test'").count() == 5


RESULTS = [
    ("uni", 0.9, 0.8, {"clf__C": "0.0"}), ("uni_float16", 0.91, 0.79, {"C": "1"}), ("gig", float("nan"), 0.7, {}), ("gig_bfloat16", 0.5, 0.7, {})]


@pytest.fixture(scope="module")
def results(spark):
    metric = "struct<mean:double,std:double,bootstrap_ci_95:array<double>>"
    data = [(m, p, {"tile_auc_roc": (a, 0.1, None)}, {"tile_auc_roc": (a, 0.1, [a - 0.1, a + 0.05]), "tile_f1": (f, 0.2, None)}) for m, a, f, p in RESULTS]
    return spark.createDataFrame(data, f"model string, best_params map<string,string>, val map<string,{metric}>, test map<string,{metric}>")


def test_benchmark_summary(results):
    table = summary.benchmark_summary(results)
    got = table.collect()
    assert [r.model for r in got] == ["uni_float16", "uni", "gig_bfloat16", "gig"]
    assert got[1].best_C == "0.0" and got[0].best_C == "1" and got[3].test_tile_auc_roc_mean is None
    assert got[1].ci_down == pytest.approx(0.1) and got[1].ci_up == pytest.approx(0.05)
    assert "val_tile_auc_roc_ci95_lo" not in table.columns


def test_precision_delta(results):
    got = {(r.base_model, r.precision, r.name): (r.delta, r.band) for r in summary.precision_delta(summary.metric_values(results)).collect()}
    assert got["uni", "float16", "test_tile_auc_roc_mean"] == (0.01, "large")
    assert got["uni", "float16", "test_tile_f1_mean"] == (-0.01, "large")
    assert ("gig", "bfloat16", "test_tile_auc_roc_mean") not in got
    assert got["gig", "bfloat16", "test_tile_f1_mean"] == (0.0, "negligible")


def test_reports(spark, results):
    reports = spark.createDataFrame([("uni", "1", "f1-score", 0.5), ("uni", "macro avg", "f1-score", 0.6), ("uni", "accuracy", "accuracy", 0.7), ("uni", "weighted avg", "auc_roc", 0.8)],
                                    "model string, class string, metric string, value double")
    assert rows(summary.per_class_f1(reports)) == [("uni", "1", 0.5)]
    assert rows(summary.per_class_table(reports, ["1", "2"])) == [("uni", 0.5, None, 0.7, 0.8)]
    assert rows(summary.report_values(reports), "name", "value") == [("class_1_f1", 0.5)]
    assert rows(summary.with_reports(results, reports), "model") == [("uni",)]
    assert schemas.names(schemas.STATUS) == schemas.STATUS_COLUMNS
