"""Shard assignment, shard manifests and tar shards. ``documents`` and ``embeddings`` stand in for feature files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import rules
from lamella.operators import manifest, progress, quality, sharding
from lamella.plans.catalog import Tables, query, text
from lamella.session import scratch_dir
from lamella.sinks.tables import shard_sink
from lamella.sources import shards


def _docs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", "n_chars")


@query("""
WITH r AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'all' ELSE lang END AS "group", row_number() OVER (PARTITION BY CASE WHEN lang = 'de' THEN 'all' ELSE lang END ORDER BY doc_id) - 1 AS r FROM documents)
SELECT doc_id, "group", r // 75 AS shard, lpad(CAST(r // 75 AS VARCHAR), 6, '0') || '.tar' AS shard_file FROM r""")
def shard_by_count(t: Tables) -> DataFrame:
    grouped = _docs(t).select("doc_id", rules.shard_group(F.when(F.col("lang") != "de", F.col("lang")), True).alias("group"))
    return sharding.assign_by_count(grouped, ["group"], ["doc_id"], 75)


@query("""
WITH existing AS (SELECT lang, max(try_cast(replace(source, 'src', '') AS BIGINT)) + 1 AS first FROM documents WHERE n_chars > 8000 GROUP BY 1),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS r FROM documents)
SELECT doc_id, lang, coalesce(first, 0) + r // 50 AS shard FROM r LEFT JOIN existing USING (lang)""")
def shard_index_continue(t: Tables) -> DataFrame:
    """Numbers go on after the highest existing shard; names that are no numbers are ignored."""
    docs = _docs(t)
    name = F.concat(F.regexp_replace("source", "^src", ""), F.when(F.col("n_chars") > 8000, ".tar").otherwise("x.tar"))
    first = sharding.next_shard(docs.select("lang", name.alias("shard_file")), ["lang"])
    return sharding.assign_by_count(docs.select("doc_id", "lang"), ["lang"], ["doc_id"], 50, first).select("doc_id", "lang", "shard")


@query("""
WITH RECURSIVE d AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents),
walk AS (
  SELECT doc_id, lang, r, n_chars AS filled, 0 AS shard FROM d WHERE r = 1
  UNION ALL
  SELECT d.doc_id, d.lang, d.r, CASE WHEN w.filled + d.n_chars > 20000 THEN d.n_chars ELSE w.filled + d.n_chars END,
         CASE WHEN w.filled + d.n_chars > 20000 THEN w.shard + 1 ELSE w.shard END
  FROM walk w JOIN d ON d.lang = w.lang AND d.r = w.r + 1)
SELECT doc_id, lang, CAST(shard AS BIGINT) AS shard FROM walk""")
def shard_by_bytes(t: Tables) -> DataFrame:
    return sharding.assign_by_bytes(_docs(t).select("doc_id", "lang", "n_chars"), ["lang"], ["doc_id"], "n_chars", 20000).select(
        "doc_id", "lang", "shard")




@query("""
WITH RECURSIVE top AS (
  SELECT lang, arg_max(n_chars, (CAST(replace(source, 'src', '') AS BIGINT), n_chars)) AS length, max(CAST(replace(source, 'src', '') AS BIGINT)) AS no FROM documents GROUP BY 1),
opened AS (SELECT lang, CASE WHEN length < 9000 THEN no ELSE no + 1 END AS first, CASE WHEN length < 9000 THEN length END AS held FROM top),
d AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents),
walk AS (
  SELECT doc_id, d.lang, r, CASE WHEN held IS NULL OR held + n_chars > 9000 THEN n_chars ELSE held + n_chars END AS filled,
         CASE WHEN held IS NOT NULL AND held + n_chars > 9000 THEN first + 1 ELSE first END AS shard FROM d JOIN opened USING (lang) WHERE r = 1
  UNION ALL
  SELECT d.doc_id, d.lang, d.r, CASE WHEN w.filled + d.n_chars > 9000 THEN d.n_chars ELSE w.filled + d.n_chars END,
         CASE WHEN w.filled + d.n_chars > 9000 THEN w.shard + 1 ELSE w.shard END
  FROM walk w JOIN d ON d.lang = w.lang AND d.r = w.r + 1)
SELECT doc_id, lang, CAST(shard AS BIGINT) AS shard FROM walk""")
def shard_bytes_continue(t: Tables) -> DataFrame:
    """Packing that goes on in the last unsealed shard of each group."""
    docs = _docs(t)
    existing = docs.select("lang", F.concat(F.regexp_replace("source", "^src", ""), F.lit(".tar")).alias("shard_file"),
                           F.col("n_chars").alias("length"))
    opened = sharding.open_shard(existing, ["lang"], 9000)
    return sharding.assign_by_bytes(docs.select("doc_id", "lang", "n_chars"), ["lang"], ["doc_id"], "n_chars", 9000, opened).select(
        "doc_id", "lang", "shard")


_APPEND_SQL = """
idx AS (SELECT 'd' || doc_id AS slide_id FROM documents WHERE n_chars > 5000),
routing AS (SELECT 'd' || doc_id AS slide_id, max(CASE WHEN quality = 1 THEN 'good' ELSE '' END) AS project_id FROM labels GROUP BY 1),
planned AS (
  SELECT 'd' || doc_id AS slide_id, CASE WHEN i.slide_id IS NOT NULL THEN 'indexed' WHEN coalesce(r.project_id, '') = '' THEN 'no_group' ELSE 'append' END AS fate
  FROM documents LEFT JOIN idx i ON i.slide_id = 'd' || doc_id LEFT JOIN routing r ON r.slide_id = 'd' || doc_id WHERE lang <> 'de')
"""


def _planned(t: Tables) -> DataFrame:
    slide = F.concat(F.lit("d"), "doc_id").alias("slide_id")
    docs = t.documents
    index = docs.where("n_chars > 5000").select(slide, F.lit("m").alias("model"))
    routing = t.labels.select(slide, F.when(F.col("quality") == 1, " good ").otherwise(" ").alias("project_id"))
    return sharding.plan_append(docs.select(slide), index, routing, "m", failed=docs.where("lang = 'de'").select(slide))


@query(f"WITH {_APPEND_SQL} SELECT slide_id, fate FROM planned")
def shard_append_plan(t: Tables) -> DataFrame:
    return _planned(t).select("slide_id", "fate")


@query(f"""
WITH {_APPEND_SQL}
SELECT count(*) FILTER (fate = 'append') AS n_appended, count(*) FILTER (fate = 'indexed') AS n_skipped,
       count(*) FILTER (fate = 'no_group') AS n_missing_group FROM planned""")
def shard_append_summary(t: Tables) -> DataFrame:
    return sharding.run_summary(_planned(t))


@query("""
SELECT 'd' || doc_id AS slide_id, 's3://w/m/' || lang || '/' || source || '.tar' AS wds_path FROM documents
WHERE n_chars > 5000 AND NOT (lang = 'de' AND source < 'src5') AND (lang = 'fr' OR source < 'src3')""")
def shard_manifest_entries(t: Tables) -> DataFrame:
    """Index pruned of this batch's failures, then the entries for new and confirmed slides."""
    slide = F.concat(F.lit("d"), "doc_id").alias("slide_id")
    docs = t.documents
    index = docs.where("n_chars > 5000").select(F.lit("m").alias("model"), slide, F.col("lang").alias("project_id"),
                                                F.concat("lang", F.lit("/"), "source", F.lit(".tar")).alias("shard_file"))
    pruned = sharding.prune_index(index, docs.where("lang = 'de'").select(slide), docs.where("source < 'src5'").select(slide))
    return sharding.manifest_entries(pruned, docs.where("lang = 'fr'").select(slide), "s3://w/",
                                     docs.where("source < 'src3'").select(slide)).select("slide_id", "wds_path")


def _entries(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("slide_id"), F.col("l_returnflag").alias("model"), F.col("l_suppkey").alias("wds_path"))


@query("SELECT l_returnflag AS model, count(DISTINCT l_orderkey) AS n_slides FROM lineitem GROUP BY 1")
def unique_per_model(t: Tables) -> DataFrame:
    return manifest.unique_slides(_entries(t))


@query("""
SELECT model, count(*) AS n_shards, round(avg(n), 1) AS avg_rows, min(n) AS min_rows, max(n) AS max_rows
FROM (SELECT l_returnflag AS model, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def shard_distribution(t: Tables) -> DataFrame:
    return manifest.shard_distribution(_entries(t))


@query("""
WITH per AS (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1),
m AS (SELECT l_returnflag, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1)
SELECT least((SELECT min(n) FROM m), (SELECT count(*) FROM orders)) AS done_min, least((SELECT count(*) FROM per WHERE n = 3), (SELECT count(*) FROM orders)) AS done_all""")
def done_all_models(t: Tables) -> DataFrame:
    return manifest.done_counts(_entries(t), ["A", "N", "R"], t.orders.agg(F.count(F.lit(1))).scalar())


@query("""
SELECT model, count(*) FILTER (l_orderkey IS NULL) AS n_missing
FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') CROSS JOIN (SELECT unnest(['A', 'N']) AS model)
LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) ON l_orderkey = o_orderkey AND l_returnflag = model GROUP BY 1""")
def manifest_gap(t: Tables) -> DataFrame:
    state = t.orders.select(F.col("o_orderkey").alias("slide_id"), F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").otherwise("PENDING").alias("status"))
    return manifest.manifest_gap(state, _entries(t), ["A", "N"])


@query("SELECT lang AS model, count(*) AS n_objects, count(*) FILTER (n_chars > 1000) AS n_shards FROM documents GROUP BY 1")
def shard_counts(t: Tables) -> DataFrame:
    listing = t.documents.select(F.col("lang").alias("model"), F.concat("source", F.when(F.col("n_chars") > 1000, ".tar").otherwise(".json")).alias("path"))
    return progress.shard_counts(listing)


@query("""
SELECT source AS shard, count(*) FILTER (n_chars > 200) AS n_members, count(*) FILTER (n_chars > 200 AND lang = 'de') AS n_features,
       CASE WHEN count(*) FILTER (n_chars > 200) = 0 THEN 'empty shard' WHEN count(*) FILTER (n_chars > 200 AND lang = 'de') = 0 THEN 'no feature entry' END AS error
FROM documents GROUP BY 1""")
def shard_members_check(t: Tables) -> DataFrame:
    member = F.when(F.col("n_chars") > 200, F.concat("doc_id", F.when(F.col("lang") == "de", ".features.npy").otherwise(".coords.npy")))
    return quality.check_shards(t.documents.select(F.col("source").alias("shard"), member.alias("member")))


@query("""
WITH m AS (SELECT doc_id, 'd' || doc_id AS slide_id, CASE WHEN lang = 'en' THEN 'x_features_tensor_path' ELSE 'tiles_h5_path' END AS key, source || '/' || doc_id AS value FROM documents),
files AS (SELECT source || '/' || doc_id AS value FROM documents WHERE n_chars > 500)
SELECT slide_id, key, CASE WHEN value NOT IN (SELECT value FROM files) THEN 'file missing'
       WHEN key = 'tiles_h5_path' AND doc_id NOT IN (SELECT page_id FROM pages) THEN 'no coords'
       WHEN key = 'x_features_tensor_path' AND doc_id NOT IN (SELECT vec_id FROM embeddings) THEN 'no features' END AS error
FROM m WHERE error IS NOT NULL""")
def manifest_check(t: Tables) -> DataFrame:
    docs = t.documents
    slide = lambda c: F.concat(F.lit("d"), c).alias("slide_id")
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    entries = docs.select(slide("doc_id"), F.when(F.col("lang") == "en", "x_features_tensor_path").otherwise("tiles_h5_path").alias("key"), path.alias("value"))
    listing = docs.where("n_chars > 500").select(path.alias("path"))
    tiles = t.pages.select(slide("page_id"), F.lit(0).alias("x"), F.lit(0).alias("y"))
    features = t.embeddings.select(slide("vec_id"), F.col("embedding").alias("features"))
    return quality.check_manifest(entries, listing, tiles, features).drop("value")


@query("""
SELECT CAST(label AS VARCHAR) AS slide_id, count(*) AS n_tiles, sum(len(embedding)) AS n_values, round(sum(list_sum(embedding::DOUBLE[])), 4) AS total,
       sum(vec_id) AS coords FROM embeddings GROUP BY 1""")
def shard_roundtrip(t: Tables) -> DataFrame:
    """Embeddings written as tar shards (label as slide), read back and summed up."""
    tiles = t.embeddings.select(text("label").alias("slide_id"), F.lit("m").alias("model"), F.col("vec_id").cast("int").alias("tile_idx"),
                                F.col("embedding").alias("features"), F.col("vec_id").alias("x"), F.lit(0).cast("bigint").alias("y"),
                                F.lit("float32").alias("precision"))
    sizes = tiles.groupBy("model", "slide_id").agg((F.sum(F.size("features")) * 4).alias("bytes")).withColumn("group", F.lit("all"))
    assigned = sharding.assign_by_bytes(sizes, ["model", "group"], ["slide_id"], "bytes", 40000)
    folder = scratch_dir(t.spark, "shards")
    shard_sink(tiles, assigned, folder)
    back = shards.shard_scan(t.spark, folder)
    total = F.aggregate(F.transform("features", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return back.groupBy("slide_id").agg(F.count("*").alias("n_tiles"), F.sum(F.size("features")).alias("n_values"),
                                        F.round(F.sum(total), 4).alias("total"), F.sum("x").alias("coords"))
