"""Round trips through files: the input tables are written by a sink (or as another program would leave them), read back
by the matching scan, and compared as rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import predicates
from lamella.plans.catalog import Tables, day, query, text
from lamella.session import open_path, scratch_dir
from lamella.sinks import tables
from lamella.sources import documents, files, sheets


def _order_sheet(t: Tables) -> DataFrame:
    """A samples sheet of the orders: some paths are of unknown type, some ids hold a blank, some samples are blank."""
    key = text("o_orderkey")
    return t.orders.select(
        F.concat(F.lit("S"), key, F.when(F.col("o_orderkey") % 11 == 0, " x").otherwise("")).alias("slide_id"),
        F.concat(F.lit("/slides/"), key, F.when(F.col("o_orderkey") % 13 == 0, ".jpg").otherwise(".svs")).alias("slide_path"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("C"), "o_custkey")).alias("sample_id"),
        F.col("o_orderpriority").alias("oncotree_code"),
        F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("").alias("needs_download"))


@query("""
WITH ok AS (SELECT 'S' || o_orderkey AS slide_id, CASE WHEN o_orderstatus = 'P' THEN 'S' || o_orderkey ELSE 'C' || o_custkey END AS sample_id,
                   o_orderstatus = 'F' AS needs_download FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)
SELECT slide_id, sample_id, needs_download, count(*) OVER (PARTITION BY sample_id) AS n_slides FROM ok""")
def samples_sheet_file(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "sheet")
    tables.csv_sink(_order_sheet(t), path)
    valid, _ = sheets.samples_scan(t.spark, path)
    return valid.select("slide_id", "sample_id", "needs_download", "n_slides")


@query("""
SELECT CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 13 = 0 THEN 2 ELSE 1 END AS n_reasons, count(*) AS n
FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 GROUP BY 1""")
def samples_sheet_rejects(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "sheet")
    tables.csv_sink(_order_sheet(t), path)
    _, rejected = sheets.samples_scan(t.spark, path)
    return rejected.groupBy(F.size("reasons").alias("n_reasons")).agg(F.count("*").alias("n"))


@query("""
SELECT 'S' || o_orderkey AS slide_id, o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 AS valid FROM orders""")
def annotations_file(t: Tables) -> DataFrame:
    path, key = scratch_dir(t.spark, "annotations"), text("o_orderkey")
    rows = t.orders.select(F.concat(F.lit("S"), key).alias("slide_id"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(
        F.concat(F.lit("/masks/"), key, F.when(F.col("o_orderkey") % 5 == 0, ".png").otherwise(".BMP"))).alias("annotation_bmp_path"))
    tables.csv_sink(rows, path)
    good, bad = sheets.annotations_scan(t.spark, path)
    return good.select("slide_id", F.lit(True).alias("valid")).unionByName(bad.select("slide_id", F.lit(False).alias("valid")))


@query("SELECT p_brand AS oncotree_code, p_type AS class, count(*) AS n FROM part WHERE p_partkey % 4 <> 0 GROUP BY 1, 2")
def class_map_file(t: Tables) -> DataFrame:
    """Rows with a third cell are dropped by the scan."""
    path = scratch_dir(t.spark, "classes")
    extra = F.when(F.col("p_partkey") % 4 == 0, ",more").otherwise("")
    t.part.select(F.concat(F.lit(" "), "p_brand", F.lit(" , "), "p_type", extra).alias("value")).write.text(path)
    return sheets.class_map_scan(t.spark, path).groupBy("oncotree_code", "class").agg(F.count("*").alias("n"))


@query("""
SELECT 'S' || l_orderkey AS slide_id, l_returnflag AS model, count(*) AS n, max('s3://w/' || l_suppkey) AS wds_path
FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1, 2""")
def shard_manifest_file(t: Tables) -> DataFrame:
    """Two appends; a dry run adds nothing."""
    path = scratch_dir(t.spark, "entries")
    rows = t.lineitem.select(F.concat(F.lit("S"), text("l_orderkey")).alias("slide_id"), F.col("l_returnflag").alias("model"),
                             F.concat(F.lit("s3://w/"), text("l_suppkey")).alias("wds_path"), "l_linenumber")
    for keep, dry in ((F.col("l_linenumber") < 3, False), (F.col("l_linenumber") >= 3, False), (F.lit(True), True)):
        tables.manifest_append_sink(rows.where(keep).drop("l_linenumber"), path, dry)
    found = sheets.shard_manifest_scan(t.spark, path, ["A", "N"])
    return found.groupBy("slide_id", "model").agg(F.count("*").alias("n"), F.max("wds_path").alias("wds_path"))


@query("""
SELECT 'S' || p_partkey AS slide_id, CASE WHEN p_size > 10 THEN p_size / 100.0 END AS native_mpp,
       CASE WHEN p_size > 40 THEN true WHEN p_size > 5 THEN false END AS mpp_is_fallback FROM part""")
def mpp_file(t: Tables) -> DataFrame:
    path, size = scratch_dir(t.spark, "mpp"), F.col("p_size")
    tables.csv_sink(t.part.select(F.concat(F.lit("S"), text("p_partkey")).alias("slide_id"), text(F.when(size > 10, size / 100).otherwise(-size)).alias("native_mpp"),
                                  F.when(size > 40, "header_no_mpp").when(size > 5, "header").alias("source")), path)
    return sheets.mpp_scan(t.spark, path)


@query("SELECT 'S' || c_custkey AS slide_id, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE '' END AS reason FROM customer")
def failure_file(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "failures")
    tables.csv_sink(t.customer.select(F.concat(F.lit("S"), text("c_custkey")).alias("slide_id"),
                                      F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).alias("error_msg")), path)
    return sheets.failure_scan(t.spark, path)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderstatus AS state, o_orderpriority AS reason FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0")
def jobs_file(t: Tables) -> DataFrame:
    """Other people's jobs, job steps and short lines are dropped."""
    path, key = scratch_dir(t.spark, "jobs"), F.col("o_orderkey")
    name = F.when(key % 3 == 0, "nf-TASK").otherwise("theirs")
    job = F.concat(text(key), F.when(key % 5 == 0, ".batch").otherwise(""))
    line = F.concat_ws("|", job, name, "o_orderstatus", "o_orderpriority", F.lit("node"), F.lit("/w"), F.lit("1:00"))
    t.orders.select(line.alias("value")).unionByName(t.orders.select(F.concat_ws("|", text(key), F.lit("nf-SHORT")).alias("value"))).write.text(path)
    return sheets.jobs_scan(t.spark, path).select("job_id", "state", "reason")


@query("SELECT CAST(event_id AS VARCHAR) AS task_id, event_type AS name, CAST(user_id AS VARCHAR) AS exit FROM events")
def trace_file(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "trace")
    t.events.select(text("event_id").alias("task_id"), F.col("event_type").alias("name"), text("user_id").alias("exit")).write.option(
        "header", True).option("sep", "\t").csv(path)
    return sheets.trace_scan(t.spark, path)


@query("SELECT doc_id AS slide_id, quality AS label, CASE WHEN toxic = 1 THEN 'test' ELSE 'train' END AS split FROM labels")
def labels_file(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "labels")
    tables.replace_sink(t.labels.select(F.col("doc_id").alias("slide_id"), "quality", F.when(F.col("toxic") == 1, "test").otherwise("train").alias("fold")), path)
    return documents.labels_scan(t.spark, path, "quality", "fold")


@query("SELECT CAST(p_partkey AS INTEGER) AS raw, CAST(p_size AS INTEGER) AS mapped FROM part WHERE p_partkey % 6 <> 0")
def class_mapping_file(t: Tables) -> DataFrame:
    path, key = scratch_dir(t.spark, "mapping"), F.col("p_partkey")
    line = F.when(key % 6 == 0, F.concat(F.lit("# "), text(key), F.lit(": 1"))).otherwise(F.concat(F.lit("  "), text(key), F.lit(" : "), text("p_size"), F.lit("  # note")))
    t.part.select(line.alias("value")).write.text(path)
    return documents.class_mapping_scan(t.spark, path)


@query("""
SELECT label AS slide_id, vec_id AS tile_idx, len(embedding) AS width, round(list_sum(list_transform(embedding, lambda v: v::DOUBLE)), 5) AS total
FROM embeddings UNION ALL SELECT -1, 0, 0, NULL UNION ALL SELECT -2, 0, 0, NULL UNION ALL SELECT -3, 0, 0, 0.0""")
def feature_table_file(t: Tables) -> DataFrame:
    """Feature rows published by slide prefix, beside a file that is cut short, one that is no table, and one with a broken page.

    The three are not fatal. They are listed with the rows their footers state (none for -1 and -2) and those that were decoded.
    """
    path = scratch_dir(t.spark, "features")
    rows = t.embeddings.select(text("label").alias("slide_id"), F.lit("m").alias("model"), F.col("vec_id").cast("int").alias("tile_idx"),
                               F.col("embedding").alias("features"), F.lit("float32").alias("precision"))
    tables.prefix_partition_sink(rows, path, 1)
    sound = files.file_listing(t.spark, path, [".parquet"]).agg(F.min_by("path", "length")).first()[0]
    filesystem, inner = open_path(sound)
    with filesystem.open_input_file(inner) as file:
        whole = file.read()
    page = bytearray(whole)
    page[4:len(whole) // 3] = b"\xff" * (len(whole) // 3 - 4)
    _, base = open_path(path)
    for number, content in ((1, whole[:len(whole) // 2]), (2, b"no table"), (3, bytes(page))):
        filesystem.create_dir(f"{base}/prefix=z{number}", recursive=True)
        with filesystem.open_output_stream(f"{base}/prefix=z{number}/part.parquet") as out:
            out.write(content)
    bad = documents.unreadable_files(t.spark, path).select(
        (-F.regexp_extract("path", "prefix=z([0-9])/", 1).cast("int")).alias("slide_id"), F.lit(0).alias("tile_idx"), F.lit(0).alias("width"),
        F.when(F.col("stated") > 0, F.col("found").cast("double")).alias("total"))
    usable, _ = documents.feature_rejects(documents.feature_scan(t.spark, path))
    total = F.aggregate(F.transform("features", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return usable.select(F.col("slide_id").cast("int").alias("slide_id"), "tile_idx", F.size("features").alias("width"), F.round(total, 5).alias("total")).unionByName(bad)


@query("""
SELECT label AS slide_id, i - 1 AS tile_idx, round(list_sum(list_transform(list_slice(embedding, 8 * i - 7, 8 * i), lambda v: v::DOUBLE)), 5) AS total
FROM embeddings, (SELECT unnest(range(1, 9)) AS i)""")
def matrix_rows(t: Tables) -> DataFrame:
    """Slides that hold an [8, 8] matrix become one row per tile."""
    matrix = F.array(*[F.slice("embedding", 8 * i + 1, 8) for i in range(8)])
    rows = documents.explode_matrix(t.embeddings.select(F.col("label").alias("slide_id"), matrix.alias("features")))
    total = F.aggregate(F.transform("features", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return rows.select("slide_id", "tile_idx", F.round(total, 5).alias("total"))


@query("SELECT o_orderpriority, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def newest_snapshot(t: Tables) -> DataFrame:
    """Of three snapshots, written out of order and beside one of another prefix, the newest is read."""
    folder = scratch_dir(t.spark, "snapshots")
    for hour, status in ((9, "F"), (23, "P"), (12, "O")):
        at = datetime(2024, 1, 1, hour, tzinfo=timezone.utc)
        tables.snapshot_sink(t.orders.where(F.col("o_orderstatus") != status), folder, "inventory_", at)
    tables.snapshot_sink(t.orders.limit(0), folder, "zz_other_")
    newest = files.latest_snapshot(t.spark, folder, "inventory_")
    return newest.groupBy("o_orderpriority").agg(day(F.max("o_orderdate")).alias("last_day"), F.count("*").alias("n"))


@query("SELECT o_orderstatus AS batch_id, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def batch_sheets_file(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "batches")
    tables.batch_sheet_sink(t.orders.select(F.col("o_orderstatus").alias("batch_id"), "o_orderkey", "o_custkey"), path)
    back = t.spark.read.option("header", True).csv(path)
    return back.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS slide_id, 'w' || l_linenumber AS workflow_id, key, CASE key WHEN 'flag' THEN l_returnflag ELSE CAST(l_suppkey AS VARCHAR) END AS value
FROM lineitem, (SELECT unnest(['flag', 'supp']) AS key)""")
def manifest_files(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "manifest")
    rows = t.lineitem.select(text("l_orderkey").alias("slide_id"), F.concat(F.lit("w"), text("l_linenumber")).alias("workflow_id"), "l_returnflag", "l_suppkey")
    emitted = [rows.select("slide_id", "workflow_id", F.lit("flag").alias("key"), F.col("l_returnflag").alias("value")),
               rows.select("slide_id", "workflow_id", F.lit("supp").alias("key"), text("l_suppkey").alias("value"))]
    tables.manifest_sink(emitted, path)
    good, _ = sheets.manifest_scan(t.spark, path)
    return good.select("slide_id", "workflow_id", "key", "value")


@query("SELECT o_orderstatus AS metric, o_orderpriority AS class, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2")
def report_files(t: Tables) -> DataFrame:
    """A wide report table, written as CSV and read back in long form."""
    folder = scratch_dir(t.spark, "reports")
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = t.orders.groupBy(F.col("o_orderstatus").alias("metric")).agg(*[
        F.round(F.sum(F.when(F.col("o_orderpriority") == n, F.col("o_totalprice"))), 2).alias(n) for n in names])
    tables.report_tables_sink({"report": wide}, folder)
    long = documents.report_csv_scan(t.spark, {"m": f"{folder}/report"})
    return long.select("metric", "class", "value")


@query("SELECT o_orderstatus || chr(9) || o_orderpriority || chr(9) || count(*) AS line FROM orders GROUP BY o_orderstatus, o_orderpriority")
def validation_report_file(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "validation")
    tables.validation_report_sink(t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")), path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query("SELECT 'orders' AS source_file, count(*) AS source_rows, count(*) AS target_rows, true AS ok, count(*) AS synced FROM orders")
def audit_and_status(t: Tables) -> DataFrame:
    """An audit row with the rows counted from the written footers, and the sync status beside it."""
    path = scratch_dir(t.spark, "audit")
    tables.replace_sink(t.orders, f"{path}/orders")
    number = tables.written_rows(t.spark, f"{path}/orders")
    tables.audit_sink(t.spark, f"{path}/runs", "orders", t.orders.count(), number, "catalog.orders")
    tables.sync_status_sink(t.spark, f"{path}/status", True, "done", number)
    status = t.spark.read.json(f"{path}/status").select("ok", F.col("rows").alias("synced"))
    return t.spark.read.parquet(f"{path}/runs").select("source_file", "source_rows", "target_rows").join(status, F.col("synced") == F.col("target_rows"))


@query("""
SELECT doc_id, n_chars AS length FROM documents WHERE n_chars >= 500 AND lang <> 'de' AND source <> 'src3'""")
def intake_in_progress(t: Tables) -> DataFrame:
    """Files that are large enough, of an allowed type and not being uploaded (the uploads are those of one source)."""
    path = F.concat(F.lit("/in/"), text("doc_id"), F.when(F.col("lang") == "de", ".txt").otherwise(".svs"))
    listing = t.documents.select("doc_id", path.alias("path"), F.col("n_chars").alias("length"))
    uploads = t.documents.where("source = 'src3'").select(path.alias("key"))
    return files.intake_candidates(listing, uploads, [".svs"], 500).select("doc_id", "length")


@query("""
SELECT o_orderkey, o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AS failed,
       o_orderdate > TIMESTAMP '1998-06-01' - INTERVAL 240 HOUR AS fresh,
       o_orderstatus = 'P' AND o_custkey % 3 > 0 AND o_orderdate < TIMESTAMP '1998-06-01' - INTERVAL 48 HOUR AS stuck FROM orders""")
def age_predicates(t: Tables) -> DataFrame:
    now, at = F.lit("1998-06-01 00:00:00").cast("timestamp"), F.col("o_orderdate").cast("timestamp")
    state = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "P", "RUNNING").otherwise("SUCCEEDED")
    return t.orders.select("o_orderkey", predicates.failed_for(state, F.col("o_orderpriority"), ["1-urgent", "2-high"]).alias("failed"),
                           predicates.fresh(at, now, 240).alias("fresh"), predicates.stuck(state, F.col("o_custkey") % 3, at, now, 48).alias("stuck"))
