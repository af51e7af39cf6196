"""Metric, probe and benchmark-summary queries. ``labels`` with a score from the documents' length and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella import schemas
from lamella.operators import metrics, probe, summary
from lamella.plans.catalog import Tables, query, text

_SCORED_SQL = """
scored AS (
  SELECT d.lang, l.quality AS label, round(d.n_chars / (d.n_chars + 2000.0), 6) AS score, l.toxic
  FROM labels l JOIN documents d USING (doc_id)),
lines AS (
  SELECT l_returnflag, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS label, round((l_quantity / 50 + l_discount * 5 + l_tax) / 2, 4) AS score FROM lineitem)
"""


def _scored(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "lang", "n_chars"), "doc_id").select(
        "lang", F.col("quality").alias("label"), F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0)), 6).alias("score"), "toxic")


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", (F.col("l_linestatus") == "O").cast("int").alias("label"),
                             F.round((F.col("l_quantity") / 50 + F.col("l_discount") * 5 + F.col("l_tax")) / 2, 4).alias("score"))


def _auc_sql(source: str, by: str) -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    part = f"PARTITION BY {by}" if by else ""
    return f"""
WITH {_SCORED_SQL},
c AS (SELECT {key}score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM {source} GROUP BY {key}score),
r AS (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT {key}round(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 9) AS roc_auc FROM r {group}"""


@query(_auc_sql("lines", "l_returnflag"))
def roc_auc(t: Tables) -> DataFrame:
    return metrics.roc_auc(_lines(t), ["l_returnflag"]).withColumn("roc_auc", F.round("roc_auc", 9))


@query(_auc_sql("scored", ""))
def roc_auc_overall(t: Tables) -> DataFrame:
    return metrics.roc_auc(_scored(t)).withColumn("roc_auc", F.round("roc_auc", 9))


_TOP_SQL = f"""
{_SCORED_SQL},
c AS (SELECT l_returnflag, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM lines GROUP BY 1, 2),
r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY l_returnflag) AS p, sum(neg) OVER (PARTITION BY l_returnflag) AS n
      FROM c WINDOW w AS (PARTITION BY l_returnflag ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
"""


@query(f"WITH {_TOP_SQL} SELECT l_returnflag, round(sum(pos * (tp / (tp + fp))) / sum(pos), 9) AS average_precision FROM r GROUP BY 1")
def avg_precision(t: Tables) -> DataFrame:
    return metrics.average_precision(_lines(t), ["l_returnflag"]).withColumn("average_precision", F.round("average_precision", 9))


@query(f"""
WITH {_TOP_SQL}
SELECT l_returnflag, score AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr, round(tp / (tp + fp), 9) AS precision FROM r""")
def roc_pr_curves(t: Tables) -> DataFrame:
    points = metrics.curves(_lines(t), ["l_returnflag"])
    return points.select("l_returnflag", "threshold", *[F.round(c, 9).alias(c) for c in ("fpr", "tpr", "precision")])


@query(f"""
WITH {_SCORED_SQL}
SELECT lang, CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS share_positive FROM scored GROUP BY 1, 2""")
def calibration(t: Tables) -> DataFrame:
    bins = metrics.calibration(_scored(t), 10, ["lang"])
    return bins.select("lang", "bin", "n", F.round("mean_score", 6).alias("mean_score"), F.round("share_positive", 6).alias("share_positive"))


def _predicted(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_linenumber").alias("label"), F.least(F.floor(F.col("l_quantity") / 8) + 1, F.lit(7)).cast("int").alias("prediction"))


_PREDICTED_SQL = "pred AS (SELECT l_linenumber AS label, CAST(least(floor(l_quantity / 8) + 1, 7) AS INTEGER) AS prediction FROM lineitem)"


@query(f"""
WITH {_PREDICTED_SQL},
k AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
m AS (SELECT c, (SELECT count(*) FROM pred WHERE label = c) AS support, (SELECT count(*) FROM pred WHERE prediction = c) AS claimed,
             (SELECT count(*) FROM pred WHERE prediction = c AND label = c) AS hits FROM k),
s AS (SELECT CAST(c AS VARCHAR) AS class, support, hits, coalesce(hits / nullif(claimed, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r, coalesce(2 * hits / nullif(claimed + support, 0), 0) AS f FROM m)
SELECT class, metric, round(value, 9) AS value FROM (
  SELECT class, unnest(['precision', 'recall', 'f1-score', 'support']) AS metric, unnest([p, r, f, support]) AS value FROM s
  UNION ALL SELECT 'macro avg', unnest(['precision', 'recall', 'f1-score', 'support']), unnest([avg(p), avg(r), avg(f), sum(support)]) FROM s
  UNION ALL SELECT 'weighted avg', unnest(['precision', 'recall', 'f1-score', 'support']),
    unnest([sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support)]) FROM s
  UNION ALL SELECT 'accuracy', 'accuracy', sum(hits) / sum(support) FROM s)""")
def class_report(t: Tables) -> DataFrame:
    return metrics.class_report(_predicted(t)).withColumn("value", F.round("value", 9))


@query(f"WITH {_PREDICTED_SQL} SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2")
def confusion(t: Tables) -> DataFrame:
    return metrics.confusion(_predicted(t))


@query(f"""
WITH {_PREDICTED_SQL}
SELECT label, {', '.join(f"count(*) FILTER (prediction = {c}) AS pred_{c}" for c in range(1, 8))} FROM pred GROUP BY 1""")
def confusion_matrix(t: Tables) -> DataFrame:
    return metrics.confusion_matrix(_predicted(t), range(1, 8))


@query("""
WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
e AS (SELECT label, class, round(sum(v * ((i * 31 + class * 17) % 7 - 3)), 5) AS score
      FROM v, (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS class) GROUP BY vec_id, label, class),
c AS (SELECT class, score, count(*) FILTER (label = class) AS pos, count(*) FILTER (label <> class) AS neg FROM e GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT class, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM r GROUP BY 1)
SELECT round(avg(auc), 9) AS roc_auc_macro FROM a""")
def ovr_macro_auc(t: Tables) -> DataFrame:
    """Class scores are fixed projections of the whole vector."""
    def score(c: int):
        terms = F.transform("embedding", lambda v, i: v.cast("double") * ((i * 31 + c * 17) % 7 - 3))
        return F.round(F.aggregate(terms, F.lit(0.0), lambda total, term: total + term), 5)
    scores = F.map_from_arrays(F.array(*[F.lit(c) for c in range(10)]), F.array(*[score(c) for c in range(10)]))
    return metrics.ovr_macro_auc(t.embeddings.select("label", scores.alias("scores"))).withColumn("roc_auc_macro", F.round("roc_auc_macro", 9))


@query("""
SELECT l_returnflag AS model, l_linestatus AS split, 'm' || l_linenumber AS metric, round(avg(l_discount), 9) AS mean, round(stddev_pop(l_discount), 9) AS std
FROM lineitem GROUP BY 1, 2, 3""")
def seed_summary(t: Tables) -> DataFrame:
    values = t.lineitem.select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("split"),
                               F.concat(F.lit("m"), "l_linenumber").alias("metric"), F.col("l_discount").alias("value"))
    return metrics.seed_summary(values).select("model", "split", "metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@query()
def bootstrap_ci(t: Tables) -> DataFrame:
    """Intervals of three metrics per return flag, from Poisson weights on score counts."""
    return metrics.bootstrap_ci(_lines(t), ["l_returnflag"], replicates=1000)


@query()
def linear_probe(t: Tables) -> DataFrame:
    """Grid-searched logistic regression on all embeddings, whole source ids kept together."""
    rows = t.embeddings.select(F.floor(F.col("vec_id") / 5).alias("slide_id"), (F.col("label") >= 5).cast("int").alias("label"), F.col("embedding").alias("features"))
    result = probe.linear_probe(rows)
    return result.summary


@query()
def bag_probe(t: Tables) -> DataFrame:
    """Slide-level benchmark on pooled embeddings."""
    tiles = t.embeddings.select(F.floor(F.col("vec_id") / 2).alias("slide_id"), F.col("embedding").alias("features"))
    labels = t.embeddings.groupBy(F.floor(F.col("vec_id") / 2).alias("slide_id")).agg(F.max((F.col("label") >= 5).cast("int")).alias("label"))
    result = probe.bag_probe(tiles, labels)
    return result.summary


# Summaries: one "model" per part brand, its metrics aggregated from the items sold ---

_RESULTS_SQL = """
m AS (
  SELECT p_brand || (CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN '_float16' ELSE '_bfloat16' END) AS model, l_linestatus,
         round(avg(l_discount) * 10, 6) AS auc, round(avg(l_tax) * 10, 6) AS f1, round(stddev_pop(l_tax), 6) AS std, round(min(l_discount) * 10 + 0.3, 6) AS lo, round(max(l_discount) * 10, 6) AS hi
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
flat AS (
  SELECT v.model, v.auc AS val_auc, v.f1 AS val_f1, v.std AS val_std, t.auc AS test_auc, t.f1 AS test_f1, t.std AS test_std, t.lo, t.hi
  FROM m v JOIN m t ON v.model = t.model AND v.l_linestatus = 'O' AND t.l_linestatus = 'F')
"""


def _results(t: Tables) -> DataFrame:
    """Result documents as JSON text, parsed by the result schema."""
    suffix = F.when(F.col("l_returnflag") == "A", "").when(F.col("l_returnflag") == "N", "_float16").otherwise("_bfloat16")
    joined = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    m = joined.groupBy(F.concat("p_brand", suffix).alias("model"), "l_linestatus").agg(
        F.round(F.avg("l_discount") * 10, 6).alias("auc"), F.round(F.avg("l_tax") * 10, 6).alias("f1"),
        F.round(F.stddev_pop("l_tax"), 6).alias("std"), F.round(F.min("l_discount") * 10 + 0.3, 6).alias("lo"), F.round(F.max("l_discount") * 10, 6).alias("hi"))
    entry = F.struct(F.struct(F.col("auc").alias("mean"), F.col("std"), F.array("lo", "hi").alias("bootstrap_ci_95")).alias("tile_auc_roc"),
                     F.struct(F.col("f1").alias("mean"), F.col("std")).alias("tile_f1"))
    by_split = m.groupBy("model").agg(F.max(F.when(F.col("l_linestatus") == "O", entry)).alias("val"), F.max(F.when(F.col("l_linestatus") == "F", entry)).alias("test"))
    document = F.to_json(F.struct("val", "test", F.struct(F.lit(0.1).alias("clf__C"), F.lit("l2").alias("penalty")).alias("best_params")))
    return by_split.select("model", F.from_json(document, schemas.METRIC_RESULTS).alias("r")).select("model", "r.*")


@query(f"""
WITH {_RESULTS_SQL}
SELECT model, val_auc AS val_tile_auc_roc_mean, test_auc AS test_tile_auc_roc_mean, test_f1 AS test_tile_f1_mean, test_std AS test_tile_f1_std, lo AS test_tile_auc_roc_ci95_lo,
       hi AS test_tile_auc_roc_ci95_hi, round(greatest(0, test_auc - lo), 6) AS ci_down, round(greatest(0, hi - test_auc), 6) AS ci_up, '0.1' AS best_c, 'l2' AS best_penalty FROM flat""")
def benchmark_summary(t: Tables) -> DataFrame:
    table = summary.benchmark_summary(_results(t))
    return table.select("model", "val_tile_auc_roc_mean", "test_tile_auc_roc_mean", "test_tile_f1_mean", "test_tile_f1_std", "test_tile_auc_roc_ci95_lo",
                        "test_tile_auc_roc_ci95_hi", F.round("ci_down", 6).alias("ci_down"), F.round("ci_up", 6).alias("ci_up"),
                        F.col("best_C").alias("best_c"), "best_penalty")


@query(f"""
WITH {_RESULTS_SQL},
v AS (SELECT regexp_replace(model, '_b?float16$', '') AS base_model, coalesce(nullif(regexp_extract(model, '_(b?float16)$', 1), ''), 'float32') AS precision,
             unnest(['val_tile_auc_roc_mean', 'test_tile_auc_roc_mean', 'val_tile_f1_mean', 'test_tile_f1_mean']) AS name, unnest([val_auc, test_auc, val_f1, test_f1]) AS value FROM flat)
SELECT a.base_model, a.precision, a.name, round(a.value - b.value, 6) AS delta
FROM v a JOIN v b USING (base_model, name) WHERE a.precision <> 'float32' AND b.precision = 'float32'""")
def precision_delta(t: Tables) -> DataFrame:
    change = summary.precision_delta(summary.metric_values(_results(t)))
    return change.where(F.col("name").endswith("_mean")).select("base_model", "precision", "name", "delta")


@query("""
WITH r AS (SELECT p_brand AS model, l_linenumber, avg(l_discount) AS f1, avg(l_tax) AS acc FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT model, round(max(f1) FILTER (l_linenumber = 1), 9) AS class_1_f1, round(max(f1) FILTER (l_linenumber = 2), 9) AS class_2_f1,
       round(max(acc) FILTER (l_linenumber = 3), 9) AS accuracy, round(max(acc) FILTER (l_linenumber = 4), 9) AS weighted_auc FROM r GROUP BY 1""")
def per_class_table(t: Tables) -> DataFrame:
    """F1 per class and the averages of each model, from long reports."""
    joined = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    rows = joined.groupBy(F.col("p_brand").alias("model"), "l_linenumber").agg(F.avg("l_discount").alias("f1"), F.avg("l_tax").alias("acc"))
    number = F.col("l_linenumber")
    reports = rows.select("model", F.when(number == 3, "accuracy").when(number == 4, "weighted avg").otherwise(number.cast("string")).alias("class"),
                          F.when(number == 3, "accuracy").when(number == 4, "auc_roc").otherwise("f1-score").alias("metric"),
                          F.when(number.isin(3, 4), F.col("acc")).otherwise(F.col("f1")).alias("value"))
    table = summary.per_class_table(reports, ["1", "2"])
    return table.select("model", *[F.round(c, 9).alias(c) for c in ("class_1_f1", "class_2_f1", "accuracy", "weighted_auc")])


@query("""
SELECT event_id, key, CAST(json_extract(props, '$."' || key || '"') AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def eav_props(t: Tables) -> DataFrame:
    """Values of a JSON property map as rows."""
    props = F.from_json("props", "map<string,bigint>")
    return t.events.select("event_id", F.explode(props).alias("key", "value"))
