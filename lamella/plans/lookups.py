"""Queries over listings, sheets, lookups and schema steps of the input tables, most of them written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import rules
from lamella.functions import text as texts
from lamella.operators import batching, embed, inventory, manifest, merge, progress, state, summary, tiles
from lamella.plans.catalog import Tables, query, second, text
from lamella.session import open_path, scratch_dir, stable
from lamella.sinks import tables
from lamella.sources import documents, files, sheets
from lamella.streaming import intake, jobs

# Files and sheets ------------------------------------------------------------

@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment,
       CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer""")
def string_sheet_file(t: Tables) -> DataFrame:
    """Everything is text, and what is missing is blank."""
    path, nation = scratch_dir(t.spark, "sheet"), F.col("c_nationkey")
    tables.csv_sink(t.customer.select("c_custkey", F.when(nation % 4 != 0, F.col("c_mktsegment")).alias("segment"), F.when(nation % 3 != 0, nation).alias("nation")), path)
    return sheets.string_csv(t.spark, path)


@query("SELECT 's=' || o_orderstatus || '/p=' || substr(o_orderpriority, 1, 1) AS folder, CAST(1 AS BIGINT) AS objects, count(*) AS rows FROM orders GROUP BY 1")
def object_keys(t: Tables) -> DataFrame:
    """Keys below a prefix, relative to it, from one listing; each folder's rows from the same files."""
    base = scratch_dir(t.spark, "objects")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("s"), F.substring("o_orderpriority", 1, 1).alias("p"))
    rows.repartition("s", "p").write.partitionBy("s", "p").parquet(base)
    listed = files.object_listing(t.spark, base).where(F.col("key").endswith(".parquet"))
    found = listed.groupBy(F.regexp_extract("key", "^(.*)/[^/]+$", 1).alias("folder")).agg(F.count(F.lit(1)).alias("objects"))
    held = t.spark.read.parquet(base).groupBy(F.concat(F.lit("s="), "s", F.lit("/p="), text("p")).alias("folder")).agg(F.count(F.lit(1)).alias("rows"))
    return found.join(held, "folder")


@query("SELECT DISTINCT lower(p_type) || p_size % 3 AS model FROM part WHERE p_partkey % 7 <> 0")
def discovered_models(t: Tables) -> DataFrame:
    """Models that have results in a listing of both layouts; other files name none."""
    model = F.concat(F.lower("p_type"), (F.col("p_size") % 3).cast("string"))
    name = text("p_partkey")
    path = (F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("r/tiles/x"), model, F.lit("/"), name, F.lit(".patch.h5")))
            .when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("r/features/"), model, F.lit("/"), name, F.lit(".features.pt")))
            .otherwise(F.concat(F.lit("r/features/"), model, F.lit("/pt/"), name, F.lit(".features.pt"))))
    return files.discover_models(files.parse_results(t.part.select(path.alias("path"), F.lit(1).cast("bigint").alias("length"))))


@query("SELECT 'C' || c_custkey AS slide_id, '/s/' || c_custkey AS slide_path, c_mktsegment AS oncotree_code FROM customer WHERE c_acctbal > 5000 AND c_nationkey = 7")
def sql_file_query(t: Tables) -> DataFrame:
    """A user's query kept in a file, with parameters; it must give three named columns."""
    base, view = scratch_dir(t.spark, "sql"), f"customers_{uuid.uuid4().hex[:8]}"
    t.customer.createOrReplaceTempView(view)
    words = (f"SELECT concat('C', c_custkey) AS slide_id, concat('/s/', c_custkey) AS slide_path, c_mktsegment AS oncotree_code\n"
             f"FROM {view} WHERE c_acctbal > :least AND c_nationkey = :nation ;\n")
    t.spark.createDataFrame([(words,)], "value string").coalesce(1).write.text(base)
    only = files.file_listing(t.spark, base, [".txt"]).where("length > 0").first().path
    return documents.sql_file_source(t.spark, only, args={"least": 5000, "nation": 7})


@query("""
SELECT 'S' || (c_custkey // 3) AS slide_id, 'w' AS workflow_id, min(c_name) FILTER (c_custkey % 3 = 0) AS a, min(c_name) FILTER (c_custkey % 3 = 1) AS b FROM customer GROUP BY 1""")
def wide_manifest_file(t: Tables) -> DataFrame:
    """A manifest of one row per slide and a column per key, written as a sheet and read back."""
    path, key = scratch_dir(t.spark, "wide"), F.col("c_custkey")
    rows = t.customer.select(F.concat(F.lit("S"), F.floor(key / 3).cast("string")).alias("slide_id"), F.lit("w").alias("workflow_id"),
                             F.when(key % 3 == 0, "a").when(key % 3 == 1, "b").otherwise("c").alias("key"), F.col("c_name").alias("value"))
    tables.csv_sink(manifest.wide(rows, ["a", "b"], [F.col("value")]), path)
    return t.spark.read.option("header", True).csv(path)


@query("""
SELECT 'S' || o_orderkey AS slide_id, '/p/' || o_orderkey AS slide_path, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS needs_download,
       'C' || o_custkey AS sample_id FROM orders""")
def samples_files(t: Tables) -> DataFrame:
    """The sheet and the full table beside it, joined again; flags are lower-case text in both."""
    base, key = scratch_dir(t.spark, "samples"), text("o_orderkey")
    rows = t.orders.select(F.concat(F.lit("S"), key).alias("slide_id"), F.concat(F.lit("/p/"), key).alias("slide_path"), (F.col("o_orderstatus") == "F").alias("needs_download"),
                           F.lit("f").alias("file_id"), F.lit("n").alias("file_name"), F.concat(F.lit("C"), text("o_custkey")).alias("sample_id"))
    tables.samples_sink(rows, f"{base}/sheet", f"{base}/full")
    sheet, full = (t.spark.read.option("header", True).csv(f"{base}/{n}") for n in ("sheet", "full"))
    return sheet.select("slide_id", "slide_path", "needs_download").join(full.select("slide_id", "needs_download", "sample_id"), ["slide_id", "needs_download"])


@query("""
SELECT 'm' || p_size AS model, CASE WHEN p_size % 3 = 0 THEN 'missing' WHEN p_size % 3 = 1 THEN 'partial' ELSE 'ok' END AS state
FROM part GROUP BY p_size""")
def written_sizes(t: Tables) -> DataFrame:
    """Sizes as a writer states them against the listing of what is there: lost and partial files show."""
    base = scratch_dir(t.spark, "sizes")
    t.part.select("p_partkey", F.concat(F.lit("m"), text("p_size")).alias("model"), "p_size").repartition("model").write.partitionBy("model").parquet(base)
    listed = files.object_listing(t.spark, base).where(F.col("key").endswith(".parquet"))
    number = F.regexp_extract("key", "^model=m([0-9]+)/", 1).cast("int")
    stated = listed.select("key", F.when(number % 3 == 1, F.col("length") + 1).otherwise(F.col("length")).alias("size"))
    there = listed.where(number % 3 != 0)
    bad = tables.sizes_match(stated, there).select("key", "state")
    return listed.join(bad, "key", "left").select(F.concat(F.lit("m"), number.cast("string")).alias("model"), F.coalesce("state", F.lit("ok")).alias("state"))


_MODELS = [f"model{i}" for i in range(1, 8)]


@query("""
WITH r AS (SELECT 'model' || l_linenumber AS model, round(avg(l_discount), 6) AS auc, round(avg(l_tax), 6) AS f1, count(*) AS n FROM lineitem GROUP BY 1),
w AS (SELECT 'model' || l_linenumber AS model, l_returnflag AS class, CASE WHEN l_linestatus = 'F' THEN 'precision' ELSE 'recall' END AS metric,
             round(avg(l_discount), 6) AS value FROM lineitem WHERE l_linenumber <> 3 OR l_returnflag <> 'R' GROUP BY 1, 2, 3)
SELECT r.model, auc, f1, CAST(5 AS INTEGER) AS n_seeds, class, metric, value FROM r JOIN w USING (model) WHERE r.model <> 'model6'""")
def results_with_reports(t: Tables) -> DataFrame:
    """Result documents and class reports of many models, one scan each, joined by model. Reports name their own classes;
    a model without a report is dropped."""
    base = scratch_dir(t.spark, "results")
    lines = t.lineitem.select(F.concat(F.lit("model"), text("l_linenumber")).alias("model"), "l_returnflag", "l_linestatus",
                              F.col("l_discount").cast("decimal(15,2)").alias("d"), F.col("l_tax").cast("decimal(15,2)").alias("x"), "l_linenumber")
    entry = F.create_map(F.lit("auc"), F.struct(F.round(F.avg("d"), 6).cast("double").alias("mean")), F.lit("f1"), F.struct(F.round(F.avg("x"), 6).cast("double").alias("mean")))
    found = lines.groupBy("model").agg(F.to_json(F.struct(F.lit(5).alias("n_seeds"), entry.alias("test"))).alias("value"))
    found.repartition("model").write.partitionBy("model").text(f"{base}/json")
    used = lines.where("(l_linenumber <> 3 OR l_returnflag <> 'R') AND l_linenumber <> 6").withColumn(
        "metric", F.when(F.col("l_linestatus") == "F", "precision").otherwise("recall"))
    for model, classes in (("3", ["A", "N"]), (None, ["A", "N", "R"])):
        some = used.where(F.col("l_linenumber") == 3 if model else F.col("l_linenumber") != 3)
        wide = some.groupBy("model", "metric").pivot("l_returnflag", classes).agg(F.round(F.avg("d"), 6).cast("double"))
        wide.repartition("model").write.mode("append").partitionBy("model").option("header", True).csv(f"{base}/report")
    results = documents.metrics_json_scan(t.spark, {m: f"{base}/json/model={m}" for m in _MODELS})
    reports = documents.report_csv_scan(t.spark, {m: f"{base}/report/model={m}" for m in _MODELS if m != "model6"})
    both = summary.with_reports(results, reports)
    return both.select("model", F.col("test")["auc"]["mean"].alias("auc"), F.col("test")["f1"]["mean"].alias("f1"), "n_seeds", F.inline("report"))


# Expressions and lookups -----------------------------------------------------

@query("""
SELECT c_custkey, '/Volumes/main/' || lower(c_mktsegment) || '/t' || c_nationkey AS volume, CASE WHEN c_custkey % 2 = 0 THEN 'main.' || lower(c_mktsegment) || '.t' || c_nationkey END AS table_name,
       CASE WHEN c_acctbal < 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 'Failed after max retries' ELSE c_name END ELSE '' END AS reason FROM customer""")
def volume_paths(t: Tables) -> DataFrame:
    """Three-part names as volume paths and back, and the reasons of failed rows."""
    name = F.concat(F.lit("main."), F.lower("c_mktsegment"), F.lit(".t"), text("c_nationkey"))
    volume = texts.table_to_volume(name)
    path = F.when(F.col("c_custkey") % 2 == 0, F.concat(volume, F.lit("/part/x.parquet"))).otherwise(F.concat(F.lit("/mnt"), volume))
    reason = rules.failure_reason(F.when(F.col("c_acctbal") < 0, "FAILED").otherwise("DONE"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")))
    return t.customer.select("c_custkey", volume.alias("volume"), texts.volume_to_table(path).alias("table_name"), reason.alias("reason"))


@query("""
WITH n AS (SELECT o_custkey, count(*) AS n_slides FROM orders GROUP BY 1)
SELECT o_orderkey AS slide_id, o_custkey AS sample_id, n_slides FROM orders JOIN n USING (o_custkey) WHERE n_slides > 1""")
def multi_slide_samples(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderkey").alias("slide_id"), F.col("o_custkey").alias("sample_id"))
    return batching.multi_slide(batching.with_sample_sizes(rows))


@query("""
WITH f AS (SELECT vec_id AS tile, CASE label % 3 WHEN 0 THEN 'prism_slide' WHEN 1 THEN 'uni' ELSE 'virchow' END AS model FROM embeddings)
SELECT tile, model FROM f WHERE model <> 'prism_slide' UNION ALL
SELECT vec_id, 'virchow' FROM embeddings WHERE label = 5 AND NOT EXISTS (SELECT 1 FROM f WHERE model = 'virchow')""")
def probe_tiles(t: Tables) -> DataFrame:
    """Slide encoders leave the probe's input; the tiles of their patch encoders come in unless they are there."""
    kind = F.col("label") % 3
    own = t.embeddings.select(F.col("vec_id").alias("tile"), F.when(kind == 0, "prism_slide").when(kind == 1, "uni").otherwise("virchow").alias("model"))
    patches = t.embeddings.where("label = 5").select(F.col("vec_id").alias("tile"), F.lit("virchow").alias("model"))
    return embed.probe_inputs(own, patches)


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS score FROM embeddings WHERE CAST(embedding[1] AS DOUBLE) >= 0.1")
def scored_tiles(t: Tables) -> DataFrame:
    """Tiles that a classifier's score keeps."""
    scored = t.embeddings.select("vec_id", F.col("embedding")[0].cast("double").alias("score"))
    return tiles.score_filter(scored, 0.1)


@query("""
SELECT 'path' AS look, o_orderkey FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders) UNION ALL
SELECT 'slide', o_orderkey FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders) UNION ALL
SELECT 'batch', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def state_lookups(t: Tables) -> DataFrame:
    """Rows of the state by path, by slide and by batch."""
    rows = t.orders.select("o_orderkey", F.concat(F.lit("/p/"), text("o_orderkey")).alias("slide_path"), text("o_custkey").alias("slide_id"), F.col("o_orderpriority").alias("batch_id"))
    last, first = t.orders.agg(F.max("o_orderkey"), F.min("o_custkey")).first()
    looks = [("path", state.by_path(rows, f"/p/{last}")), ("slide", state.by_slide(rows, str(first))), ("batch", state.by_batch(rows, "1-URGENT"))]
    out = [found.select(F.lit(name).alias("look"), "o_orderkey") for name, found in looks]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def stacked_tables(t: Tables) -> DataFrame:
    """Tables of one shape on top of each other, exact duplicates once."""
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    return tiles.stack([rows.where("o_orderstatus <> 'O'"), rows, rows.where("o_orderpriority = '2-HIGH'")])


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def unchanged_customers(t: Tables) -> DataFrame:
    return inventory.unchanged_keys(t.customer.where("c_custkey % 2 = 0"), t.customer.where("c_acctbal > 0"), ["c_custkey"])


@query("SELECT DISTINCT o_orderpriority AS model FROM orders UNION SELECT unnest(['1-URGENT', 'configured', 'other'])")
def observed_names(t: Tables) -> DataFrame:
    return progress.configured_and_seen(["1-URGENT", "configured", "other"], t.orders.select(F.col("o_orderpriority").alias("model")))


# Schema steps ----------------------------------------------------------------

@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def table_from_schema(t: Tables) -> DataFrame:
    """A table made from a source's schema, without rows; a second call leaves it, and rows fit into it."""
    source, name = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), f"made_{uuid.uuid4().hex[:12]}"
    merge.create_like(source, name)
    try:
        source.write.insertInto(name)
        merge.create_like(source, name)
        return stable(t.spark.table(name))
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("SELECT c_custkey AS slide_id, c_mktsegment AS status, 0 AS fail_count, '' AS error_msg FROM customer")
def migrated_state(t: Tables) -> DataFrame:
    """A state table of an older shape: one column renamed, two added, none twice."""
    old = t.customer.select(F.col("c_custkey").alias("slide"), F.col("c_mktsegment").alias("status"))
    steps = {"slide": "slide_id"}, {"fail_count": F.lit(0), "error_msg": F.lit("")}
    return state.migrate(state.migrate(old, *steps), *steps)


# Intake streams --------------------------------------------------------------

@query("SELECT 'n' || n_nationkey AS slide_id FROM nation WHERE n_regionkey <> 2")
def file_intake_stream(t: Tables) -> DataFrame:
    """New files of an allowed type, by listing only, as a stream; files still being written and others stay out."""
    base = scratch_dir(t.spark, "inbox")
    filesystem, inner = open_path(base)
    for key, region in t.nation.select("n_nationkey", "n_regionkey").collect():  # one small file per nation
        filesystem.create_dir(f"{inner}/r{region}", recursive=True)
        for name in (f"n{key}.{'txt' if region == 2 else 'svs'}", f"n{key}.svs.part"):
            with filesystem.open_output_stream(f"{inner}/r{region}/{name}") as out:
                out.write(b"x" * 32)
    return jobs.drain(intake.file_stream(t.spark, base, [".svs"], 16), "intake").select("slide_id")


@query("""
WITH s AS (SELECT o_orderkey, 'C' || o_custkey AS sample_id, o_orderstatus AS sheet FROM orders)
SELECT 'S' || o_orderkey AS slide_id, sample_id, count(*) OVER (PARTITION BY sheet, sample_id) AS n_slides FROM s""")
def sheet_intake_stream(t: Tables) -> DataFrame:
    """Sheets as they appear, each row with the number of slides of its sample in its own sheet."""
    base, key = scratch_dir(t.spark, "sheets"), text("o_orderkey")
    rows = t.orders.select(F.concat(F.lit("S"), key).alias("slide_id"), F.concat(F.lit("/p/"), key).alias("slide_path"), F.concat(F.lit("C"), text("o_custkey")).alias("sample_id"),
                           *[F.lit("").alias(c) for c in ("oncotree_code", "file_id", "file_name")], F.lit("false").alias("needs_download"), "o_orderstatus")
    for part in ("F", "O", "P"):
        rows.where(F.col("o_orderstatus") == part).drop("o_orderstatus").coalesce(1).write.mode("append").option("header", True).csv(base)
    arrived = jobs.drain(intake.sheet_stream(t.spark, base), "sheet-intake")
    return intake.with_sheet_sizes(arrived).select("slide_id", "sample_id", "n_slides")


@query("""
WITH w AS (SELECT event_type, user_id, min(ts) AS first_at FROM events GROUP BY 1, 2)
SELECT user_id, event_type, strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_at FROM w""")
def stream_first_seen(t: Tables) -> DataFrame:
    """Each user and type once within a span of event time, so that the state holds that span only."""
    from lamella.plans.streams import _events

    rows = _events(t).withColumn("at", F.col("ts"))
    once = jobs.drain(intake.known_once(rows.select("user_id", "event_type", "at"), ["user_id", "event_type"], "at", "3650 days"), "seen")
    first = t.events.groupBy("user_id", "event_type").agg(F.min(F.col("ts").cast("timestamp")).alias("first_at"))
    return once.select("user_id", "event_type").join(first, ["user_id", "event_type"]).select("user_id", "event_type", second(F.col("first_at")).alias("first_at"))
