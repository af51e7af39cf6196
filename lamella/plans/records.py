"""Inventory, status, path and manifest queries. ``orders`` and ``part`` stand in for file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import predicates, rules
from lamella.functions import text as names
from lamella.operators import batching, embed, inventory, manifest, quality, resolve, status
from lamella.plans.catalog import Tables, day, query, text, ts
from lamella.sources import files, sheets

SYNC_DAY = "2001-09-01"
MODELS = ["alpha", "beta", "gamma"]

# Two snapshots of one inventory: the older one knows the orders placed before
# 2000, some already stamped as removed; the newer one lacks cheap finished orders.
_SNAPSHOTS_SQL = """
old AS (
  SELECT o_orderkey AS file_id, o_orderpriority AS label, o_orderdate AS updated,
         CAST(o_orderdate AS DATE) AS first_seen_date,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'O'
              THEN CAST(o_orderdate AS DATE) + 30 END AS removed_date
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
new AS (
  SELECT o_orderkey AS file_id, o_orderpriority AS label,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS updated
  FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 120000)),
merged AS (
  SELECT coalesce(n.file_id, o.file_id) AS file_id, coalesce(n.label, o.label) AS label,
         CASE WHEN o.file_id IS NULL THEN DATE '2001-09-01' ELSE o.first_seen_date END AS first_seen_date,
         CASE WHEN n.file_id IS NULL THEN coalesce(o.removed_date, DATE '2001-09-01') END AS removed_date,
         CASE WHEN o.file_id IS NULL THEN 'added'
              WHEN n.file_id IS NULL AND o.removed_date IS NULL THEN 'removed'
              WHEN n.file_id IS NULL THEN 'unchanged'
              WHEN n.updated <> o.updated THEN 'updated'
              WHEN o.removed_date IS NOT NULL THEN 'reappeared'
              ELSE 'unchanged' END AS change
  FROM old o FULL OUTER JOIN new n ON o.file_id = n.file_id)
"""


def _merged(t: Tables) -> DataFrame:
    orders = t.orders
    placed = F.to_date("o_orderdate")
    stamped = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") != "O")
    base = orders.select(F.col("o_orderkey").alias("file_id"), F.col("o_orderpriority").alias("label"),
                         "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority")
    old = base.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "file_id", "label", F.col("o_orderdate").alias("updated_datetime"), placed.alias("first_seen_date"),
        F.when(stamped, F.date_add(placed, 30)).alias("removed_date"))
    later = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(
        F.col("o_orderdate"))
    new = base.where(~((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 120000))).select(
        "file_id", "label", later.alias("updated_datetime"))
    return inventory.scd_merge(old, new, F.lit(SYNC_DAY).cast("date"))


@query(f"""
WITH {_SNAPSHOTS_SQL}
SELECT file_id, label, strftime(first_seen_date, '%Y-%m-%d') AS first_seen_date,
       strftime(removed_date, '%Y-%m-%d') AS removed_date, change FROM merged""")
def inventory_scd_merge(t: Tables) -> DataFrame:
    return _merged(t).select("file_id", "label", day(F.col("first_seen_date")).alias("first_seen_date"),
                             day(F.col("removed_date")).alias("removed_date"), "change")


@query(f"""
WITH {_SNAPSHOTS_SQL}
SELECT count(*) FILTER (change = 'added') AS n_added, count(*) FILTER (change = 'removed') AS n_removed,
       count(*) FILTER (change = 'updated') AS n_updated, count(*) FILTER (removed_date IS NULL) AS n_active
FROM merged""")
def inventory_changes(t: Tables) -> DataFrame:
    return inventory.change_counts(_merged(t))


@query(f"""
WITH {_SNAPSHOTS_SQL}
SELECT file_id, label FROM merged
WHERE first_seen_date <= DATE '1998-06-30' AND (removed_date IS NULL OR removed_date > DATE '1998-06-30')""")
def inventory_snapshot_at(t: Tables) -> DataFrame:
    return inventory.snapshot_at(_merged(t), F.lit("1998-06-30").cast("date")).select("file_id", "label")


@query(f"""
WITH {_SNAPSHOTS_SQL}
SELECT file_id, label FROM merged WHERE first_seen_date = DATE '2001-09-01' AND removed_date IS NULL""")
def inventory_new_since(t: Tables) -> DataFrame:
    fresh = inventory.new_since(_merged(t), F.lit(SYNC_DAY).cast("date"))
    return fresh.where(predicates.active(F.col("removed_date"))).select("file_id", "label")


@query("""
WITH items AS (
  SELECT l_orderkey, l_returnflag, l_linestatus, l_shipdate, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem),
firsts AS (
  SELECT l_orderkey, arg_min(l_returnflag, rn) FILTER (l_returnflag <> 'N') AS primary_diagnosis,
         arg_min(l_linestatus, rn) AS sample_type, arg_min(l_quantity, rn) AS percent_tumor_cells
  FROM items GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
       'CASE-' || o_custkey || '-DX' || (CASE o_orderstatus WHEN 'O' THEN 1 ELSE 2 END) || '.' || o_orderkey || '.svs' AS file_name,
       'DX' || (CASE o_orderstatus WHEN 'O' THEN 1 ELSE 2 END) AS slide_type, o_orderpriority AS project_id,
       primary_diagnosis, sample_type, percent_tumor_cells
FROM orders LEFT JOIN firsts ON l_orderkey = o_orderkey""")
def hits_flatten(t: Tables) -> DataFrame:
    """Nested documents built from orders and their items, flattened again."""
    place = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list(F.struct(place.alias("place"), "l_returnflag", "l_linestatus", "l_quantity"))).alias("items"))
    none = F.lit(None).cast("string")
    missing = {c: none.alias(c) for c in ("morphology", "ajcc_pathologic_stage", "tumor_grade", "tissue_type",
                                          "tumor_descriptor", "section_location", "primary_site", "disease_type",
                                          "gender", "vital_status", "race", "ethnicity")}
    diagnoses = F.transform("items", lambda i: F.struct(
        F.when(i["l_returnflag"] != "N", i["l_returnflag"]).alias("primary_diagnosis"),
        missing["morphology"], missing["ajcc_pathologic_stage"], missing["tumor_grade"]))
    percent = [F.lit(None).cast("double").alias(c) for c in ("percent_stromal_cells", "percent_necrosis", "percent_normal_cells")]
    samples = F.transform("items", lambda i: F.struct(
        i["l_linestatus"].alias("sample_type"), missing["tissue_type"], missing["tumor_descriptor"],
        F.array(F.struct(F.array(F.struct(missing["section_location"], i["l_quantity"].alias("percent_tumor_cells"),
                                          *percent)).alias("slides"))).alias("portions")))
    kind = F.when(F.col("o_orderstatus") == "O", "1").otherwise("2")
    hits = t.orders.join(items, "o_orderkey", "left").select(
        text("o_orderkey").alias("file_id"),
        F.concat(F.lit("CASE-"), "o_custkey", F.lit("-DX"), kind, F.lit("."), "o_orderkey", F.lit(".svs")).alias("file_name"),
        F.lit(0).cast("bigint").alias("file_size"), none.alias("md5sum"), none.alias("updated_datetime"),
        F.array(F.struct(
            text("o_custkey").alias("submitter_id"),
            F.struct(F.col("o_orderpriority").alias("project_id"), missing["primary_site"], missing["disease_type"]).alias("project"),
            F.struct(missing["gender"], F.lit(None).cast("bigint").alias("age_at_index"), missing["vital_status"],
                     missing["race"], missing["ethnicity"]).alias("demographic"),
            diagnoses.alias("diagnoses"), samples.alias("samples"))).alias("cases"))
    return inventory.flatten_hits(hits).select("file_id", "file_name", "slide_type", "project_id",
                                               "primary_diagnosis", "sample_type", "percent_tumor_cells")


# Status: part is the inventory, lineitem holds results and shard entries -------

_STATUS_SQL = """
models AS (SELECT unnest(['alpha', 'beta', 'gamma']) AS model),
results AS (
  SELECT 'P' || l_partkey AS slide_id, CASE l_returnflag WHEN 'A' THEN 'alpha' WHEN 'N' THEN 'beta' ELSE 'gamma' END AS model,
         max('/r/' || l_orderkey) AS path
  FROM lineitem WHERE l_quantity > 49 GROUP BY 1, 2),
shards AS (
  SELECT 'P' || l_partkey AS slide_id, CASE l_returnflag WHEN 'A' THEN 'alpha' WHEN 'N' THEN 'beta' ELSE 'gamma' END AS model,
         max('s3://w/' || l_suppkey) AS wds_path
  FROM lineitem WHERE l_quantity <= 2 GROUP BY 1, 2),
slides AS (
  SELECT p_partkey AS file_id, 'P' || p_partkey AS slide_id, p_brand AS project_id, p_type AS slide_type,
         CASE WHEN p_size > 40 THEN 'too large' END AS failure,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size / 100.0 END AS native_mpp,
         CASE WHEN p_size % 5 = 0 THEN TRUE WHEN p_size < 45 THEN FALSE END AS mpp_is_fallback
  FROM part),
status AS (
  SELECT s.file_id, s.slide_id, s.project_id, s.slide_type, m.model,
         CASE WHEN r.path IS NOT NULL OR h.wds_path IS NOT NULL THEN 'done'
              WHEN failure IS NOT NULL THEN 'failed' ELSE 'pending' END AS status,
         CASE WHEN r.path IS NULL AND h.wds_path IS NULL AND failure IS NOT NULL THEN failure ELSE '' END AS failure_reason,
         native_mpp, mpp_is_fallback, CASE WHEN mpp_is_fallback THEN 0.5 ELSE native_mpp END AS tiling_mpp,
         coalesce(r.path, h.wds_path, '') AS wds_path
  FROM slides s CROSS JOIN models m
  LEFT JOIN results r ON r.slide_id = s.slide_id AND r.model = m.model
  LEFT JOIN shards h ON h.slide_id = s.slide_id AND h.model = m.model)
"""


def _slides(t: Tables) -> DataFrame:
    return t.part.select(text("p_partkey").alias("file_id"), F.concat(F.lit("P"), "p_partkey", F.lit(".x.svs")).alias("file_name"),
                         F.col("p_brand").alias("project_id"), F.col("p_type").alias("slide_type"),
                         F.col("p_name").alias("sample_type"), F.col("p_size").alias("file_size"))


def _model():
    return F.when(F.col("l_returnflag") == "A", "alpha").when(F.col("l_returnflag") == "N", "beta").otherwise("gamma")


def _status(t: Tables) -> DataFrame:
    line = t.lineitem.select(F.concat(F.lit("P"), "l_partkey").alias("slide_id"), _model().alias("model"),
                             "l_quantity", "l_orderkey", "l_suppkey")
    results = line.where("l_quantity > 49").select("slide_id", "model", F.concat(F.lit("/r/"), "l_orderkey").alias("path"))
    shards = line.where("l_quantity <= 2").select("slide_id", "model", F.concat(F.lit("s3://w/"), "l_suppkey").alias("wds_path"))
    part = t.part.withColumn("slide_id", F.concat(F.lit("P"), "p_partkey"))
    failures = part.where("p_size > 40").select("slide_id", F.lit("too large").alias("reason"))
    no_mpp = F.col("p_size") % 5 == 0
    mpp = part.select("slide_id", F.when(~no_mpp, F.col("p_size") / F.lit(100.0)).alias("native_mpp"),
                      F.when(no_mpp, True).when(F.col("p_size") < 45, False).alias("mpp_is_fallback"))
    return status.build_status(_slides(t), MODELS, results, shards, failures, mpp, F.current_timestamp())


@query(f"""
WITH {_STATUS_SQL}
SELECT CAST(file_id AS VARCHAR) AS file_id, slide_id, project_id, slide_type, model, status, failure_reason,
       native_mpp, mpp_is_fallback, tiling_mpp, wds_path FROM status""")
def status_by_model(t: Tables) -> DataFrame:
    return _status(t).drop("last_updated")


@query(f"""
WITH {_STATUS_SQL}
SELECT project_id, model, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed,
       count(*) FILTER (status = 'pending') AS pending FROM status GROUP BY 1, 2""")
def status_pivot(t: Tables) -> DataFrame:
    return status.status_pivot(_status(t))


@query(f"""
WITH {_STATUS_SQL}
SELECT CAST(s.file_id AS VARCHAR) AS file_id, model, status,
       coalesce(CASE WHEN s.slide_type IN ('SMALL', 'LARGE') THEN NULL ELSE s.slide_type END, 'from inventory') AS slide_type,
       p_name AS sample_type, CAST(p_size AS DOUBLE) AS file_size, mpp_is_fallback
FROM status s JOIN part ON p_partkey = s.file_id""")
def status_export(t: Tables) -> DataFrame:
    """Status joined to the inventory; blank slide types are filled from it."""
    blanked = _status(t).withColumn("slide_type", F.when(F.col("slide_type").isin("SMALL", "LARGE"), "").otherwise(F.col("slide_type")))
    listed = _slides(t).withColumn("slide_type", F.lit("from inventory"))
    return status.export_with_inventory(blanked, listed).select(
        "file_id", "model", "status", "slide_type", "sample_type", "file_size", "mpp_is_fallback")


_PENDING_SQL = f"""
{_STATUS_SQL},
pending AS (
  SELECT p_partkey AS file_id, 'P' || p_partkey AS slide_id, p_brand AS project_id, p_size
  FROM part
  WHERE (p_type LIKE 'S%' OR p_type LIKE 'PROMO%') AND (lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%small%' OR lower(p_name) LIKE '%blue%')
    AND p_brand <> 'Brand#1' AND 'P' || p_partkey NOT IN (SELECT slide_id FROM status WHERE status = 'done'))
"""
_BRANDS = ",".join(f"Brand#{i}" for i in range(2, 100))


def _pending(t: Tables, limit: int | None = None) -> DataFrame:
    done = resolve.done_slides(_status(t))
    return resolve.pending(_slides(t), done, "S,PROMO", "Red, small,BLUE", _BRANDS, limit=limit)


@query(f"WITH {_PENDING_SQL} SELECT CAST(file_id AS VARCHAR) AS file_id, slide_id, project_id FROM pending")
def pending_slides(t: Tables) -> DataFrame:
    return _pending(t).select("file_id", "slide_id", "project_id")


@query(f"""
WITH {_PENDING_SQL}
SELECT CAST(file_id AS VARCHAR) AS file_id, slide_id, project_id FROM pending
ORDER BY project_id, slide_id, CAST(file_id AS VARCHAR) LIMIT 20""")
def pending_first_slides(t: Tables) -> DataFrame:
    """The first twenty in order: the operator's own limit, applied before any path lookup."""
    return _pending(t, limit=20).select("file_id", "slide_id", "project_id")


_LISTING_SQL = """
local AS (SELECT l_partkey, max(CAST(l_quantity AS BIGINT)) AS length FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01' GROUP BY 1),
remote AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_discount >= 0.1),
resolved AS (
  SELECT p_partkey, p_size, l.length IS NOT NULL AND (p_size = 0 OR l.length = p_size) AS have_local, r.l_partkey IS NOT NULL AS have_remote
  FROM part LEFT JOIN local l ON l.l_partkey = p_partkey LEFT JOIN remote r ON r.l_partkey = p_partkey)
"""


def _resolved(t: Tables) -> DataFrame:
    key = F.concat_ws("/", F.col("l_partkey").cast("string"), F.concat(F.lit("P"), "l_partkey", F.lit(".x.svs")))
    local = t.lineitem.where(F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")).select(
        key.alias("key"), F.col("l_quantity").cast("bigint").alias("length"))
    remote = t.lineitem.where("l_discount >= 0.1").select(key.alias("key"))
    slides = _slides(t).withColumn("slide_id", names.slide_id_from_filename(F.col("file_name")))
    return resolve.resolve_paths(slides, local, "/data/slides", remote, "s3://bucket/base/")


@query(f"""
WITH {_LISTING_SQL}
SELECT 'P' || p_partkey AS slide_id,
       CASE WHEN NOT have_local AND have_remote THEN 's3://bucket/base/' ELSE '/data/slides/' END || p_partkey || '/P' || p_partkey || '.x.svs' AS slide_path,
       NOT (have_local OR have_remote) AS needs_download FROM resolved""")
def path_resolution(t: Tables) -> DataFrame:
    return _resolved(t).select("slide_id", "slide_path", "needs_download")


@query(f"""
WITH {_LISTING_SQL}
SELECT count(*) FILTER (have_local OR have_remote) AS n_ready,
       count(*) FILTER (NOT (have_local OR have_remote)) AS n_needs_download FROM resolved""")
def path_readiness(t: Tables) -> DataFrame:
    return resolve.readiness_counts(_resolved(t))


@query(f"""
WITH {_LISTING_SQL}
SELECT p_partkey AS key, CASE WHEN l.length IS NULL THEN 'missing' WHEN l.length = p_size THEN 'ok' ELSE 'partial' END AS state
FROM part LEFT JOIN local l ON l.l_partkey = p_partkey""")
def partial_downloads(t: Tables) -> DataFrame:
    listing = t.lineitem.where(F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")).select(
        F.col("l_partkey").alias("key"), F.col("l_quantity").cast("bigint").alias("length"))
    expected = t.part.select(F.col("p_partkey").alias("key"), F.col("p_size").alias("size"))
    return quality.check_sizes(expected, listing).select("key", "state")


@query("""
WITH listing AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN TRUE ELSE l_orderkey IS NOT NULL END AS present
FROM orders LEFT JOIN listing ON l_orderkey = o_orderkey""")
def existence_check(t: Tables) -> DataFrame:
    """Object-store paths are looked up in one listing; other paths pass."""
    scheme = F.when(F.col("o_orderstatus") == "F", "/disk/").otherwise("s3://bucket/")
    slides = t.orders.select("o_orderkey", F.concat(scheme, "o_orderkey").alias("slide_path"))
    listing = t.lineitem.where("l_returnflag = 'A'").select(F.concat(F.lit("s3://bucket/"), "l_orderkey").alias("uri"))
    return resolve.check_exists(slides, listing).select("o_orderkey", F.col("exists").alias("present"))


@query("""
SELECT o_orderkey AS slide_id, '/img/' || o_orderkey AS slide_path, c_mktsegment AS oncotree_code
FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderpriority <> '4-NOT SPECIFIED' AND o_totalprice >= 100000 AND o_orderstatus IN ('O', 'P') AND (c_acctbal > 0)""")
def matched_slides(t: Tables) -> DataFrame:
    images = t.orders.select(F.col("o_custkey").alias("image_id"), "o_orderkey",
                             F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit("/img/"), "o_orderkey")).alias("path"),
                             F.col("o_totalprice").alias("size"), F.col("o_orderstatus").alias("source"))
    matches = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("image_id"), F.col("c_mktsegment").alias("oncotree_code"))
    found = resolve.matched(matches, images, 100000, ["O", "P"], "o_orderkey >= 0")
    return found.select(F.element_at(F.split("slide_path", "/"), -1).cast("bigint").alias("slide_id"), "slide_path", "oncotree_code")


@query("""
SELECT slide_id, slide_path, oncotree_code FROM (
  SELECT 'C' || c_custkey AS slide_id, 's3://b/' || c_name || '.svs' AS slide_path, c_mktsegment AS oncotree_code, c_acctbal FROM customer)
WHERE c_acctbal >= 1000""")
def sql_query_source(t: Tables) -> DataFrame:
    """A user's own SQL as slide source, with a named argument and its column contract."""
    from lamella.sources.documents import sql_source
    t.customer.createOrReplaceTempView("lamella_slides")
    return sql_source(t.spark, "SELECT 'C' || c_custkey AS slide_id, 's3://b/' || c_name || '.svs' AS slide_path,"
                               " c_mktsegment AS oncotree_code FROM lamella_slides WHERE c_acctbal >= :low", {"low": 1000})


# Manifests ---------------------------------------------------------------------

_LINES_SQL = """
lines AS (
  SELECT event_id, ts, 'u' || user_id AS slide_id, event_type AS key, CAST(event_id AS VARCHAR) AS value FROM events WHERE event_type <> 'error'),
latest AS (
  SELECT slide_id, 'w' AS workflow_id, key, arg_max(value, (ts, event_id)) AS value FROM lines GROUP BY slide_id, key)
"""


def _manifest(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Manifest lines from events: views in the older five-cell form, errors malformed."""
    user = F.concat(F.lit("u"), "user_id")
    line = (F.when(F.col("event_type") == "error", F.concat_ws(",", user, F.lit("broken")))
            .when(F.col("event_type") == "view", F.concat_ws(",", user, F.lit("sample"), F.lit("w"), "event_type", text("event_id")))
            .otherwise(F.concat_ws(",", user, F.lit("w"), "event_type", text("event_id"))))
    lines = t.events.select(line.alias("value"), F.lit("events").alias("path"), F.col("ts").alias("modified"), F.col("event_id").alias("line_no"))
    return sheets.parse_manifest_lines(lines)


@query(f"WITH {_LINES_SQL} SELECT slide_id, workflow_id, key, value FROM latest")
def manifest_latest(t: Tables) -> DataFrame:
    return manifest.combine_manifests(_manifest(t)[0])


@query("SELECT count(*) AS n_malformed FROM events WHERE event_type = 'error'")
def manifest_malformed(t: Tables) -> DataFrame:
    return _manifest(t)[1].agg(F.count("*").alias("n_malformed"))


@query("""
SELECT 'u' || user_id AS slide_id, 'w' AS workflow_id,
       arg_min(event_id, (ts, event_id)) FILTER (event_type = 'view') AS "view", arg_min(event_id, (ts, event_id)) FILTER (event_type = 'click') AS click,
       arg_min(event_id, (ts, event_id)) FILTER (event_type = 'signup') AS signup, arg_min(event_id, (ts, event_id)) FILTER (event_type = 'purchase') AS purchase
FROM events WHERE event_type <> 'error' GROUP BY 1, 2""")
def manifest_wide(t: Tables) -> DataFrame:
    rows = _manifest(t)[0].withColumn("value", F.col("value").cast("bigint"))
    return manifest.wide(rows, ["view", "click", "signup", "purchase"], [F.col("modified"), F.col("line_no")])


@query("""
SELECT 'd' || doc_id AS slide_id, 'w' AS workflow_id,
       CASE WHEN lang = 'en' THEN source || '_features_tensor_path' WHEN lang = 'fr' THEN 'tiles_h5_path' ELSE 'filtered_tiles_h5_path' END AS key
FROM documents WHERE lang <> 'de'""")
def manifest_from_listing(t: Tables) -> DataFrame:
    slide = F.concat(F.lit("d"), "doc_id")
    path = (F.when(F.col("lang") == "en", F.concat(F.lit("features/"), "source", F.lit("/pt/"), slide, F.lit(".features.pt")))
            .when(F.col("lang") == "fr", F.concat(F.lit("tiles/"), slide, F.lit(".patch.h5")))
            .when(F.col("lang") == "es", F.concat(F.lit("filter_tiles/x/"), slide, F.lit(".patch.h5")))
            .otherwise(F.concat(F.lit("logs/"), slide, F.lit(".txt"))))
    return manifest.manifest_rows(t.documents.select(path.alias("path")), "w").drop("value")


@query("""
WITH files AS (
  SELECT 'd' || (doc_id // 2) AS slide_id, lang AS model, doc_id, source < 'src5' AS nested,
         'out/features/' || lang || (CASE WHEN source < 'src5' THEN '/pt/sub/' ELSE '/' END) || 'd' || (doc_id // 2) || '.features.pt' AS path
  FROM documents WHERE n_chars >= 300)
SELECT slide_id, model, arg_max(path, (nested, path)) AS path FROM files GROUP BY 1, 2""")
def result_listing(t: Tables) -> DataFrame:
    """Result files of both layouts; the older layout wins when a slide has both."""
    slide = F.concat(F.lit("d"), F.floor(F.col("doc_id") / 2).cast("bigint"))
    middle = F.when(F.col("source") < "src5", "/pt/sub/").otherwise("/")
    suffix = F.when(F.col("n_chars") >= 300, ".features.pt").otherwise(".log")
    listing = t.documents.select(F.concat(F.lit("out/features/"), "lang", middle, slide, suffix).alias("path"))
    return files.parse_results(listing)


@query("""
WITH listed AS (SELECT url, length(html) AS length, lower(regexp_extract(url, '(\\.[a-z]+)$', 1)) AS ext FROM pages)
SELECT url AS path, length FROM listed WHERE length >= 1500 AND ext IN ('.html')""")
def intake_filter(t: Tables) -> DataFrame:
    """Allowed suffix, minimum size and settled names over a listing."""
    listing = t.pages.select(F.col("url").alias("path"), F.length("html").cast("bigint").alias("length"))
    return files.intake_candidates(listing, None, [".HTML"], 1500).select("path", "length")


# Sheets and batches -------------------------------------------------------------

_ARRIVALS_SQL = """
arrivals AS (
  SELECT 'S' || o_custkey AS slide_id, o_orderkey AS arrival,
         CASE WHEN o_orderstatus = 'O' THEN 'gdc://' || o_orderkey || '/f' || o_orderkey || '.svs'
              WHEN o_orderpriority = '5-LOW' THEN '' ELSE 's3://b/' || o_orderkey || '.svs' END AS slide_path FROM orders),
firsts AS (SELECT slide_id, arg_min(slide_path, (slide_path LIKE 'gdc://%', arrival)) AS slide_path FROM arrivals GROUP BY 1)
"""


def _arrivals(t: Tables) -> DataFrame:
    uri = F.concat(F.lit("gdc://"), "o_orderkey", F.lit("/f"), "o_orderkey", F.lit(".svs"))
    path = (F.when(F.col("o_orderstatus") == "O", uri).when(F.col("o_orderpriority") == "5-LOW", "")
            .otherwise(F.concat(F.lit("s3://b/"), "o_orderkey", F.lit(".svs"))))
    none = F.lit(None).cast("string")
    return t.orders.select(F.concat(F.lit("S"), "o_custkey").alias("slide_id"), F.col("o_orderkey").alias("arrival"),
                           path.alias("slide_path"), none.alias("file_id"), none.alias("file_name"), none.alias("oncotree_code"),
                           (F.col("o_orderstatus") == "O").alias("needs_download"))


@query(f"""
WITH {_ARRIVALS_SQL}
SELECT slide_id, slide_path, slide_path LIKE 'gdc://%' AS needs_download,
       CASE WHEN slide_path LIKE 'gdc://%' THEN split_part(slide_path, '/', 3) END AS file_id,
       CASE WHEN slide_path LIKE 'gdc://%' THEN split_part(slide_path, '/', 4) END AS file_name
FROM firsts WHERE slide_path <> ''""")
def batch_sheet(t: Tables) -> DataFrame:
    return batching.batch_sheet(_arrivals(t), "arrival").drop("oncotree_code")


@query("SELECT doc_id, source AS sample_id, count(*) OVER (PARTITION BY source) AS n_slides FROM documents")
def sample_sizes(t: Tables) -> DataFrame:
    return batching.with_sample_sizes(t.documents.select("doc_id", F.col("source").alias("sample_id")))


@query("SELECT doc_id, (row_number() OVER (ORDER BY source, doc_id) - 1) // 12 AS batch_no FROM documents")
def collated_batches(t: Tables) -> DataFrame:
    return batching.collate(t.documents.select("source", "doc_id"), ["source", "doc_id"], 12).select("doc_id", "batch_no")


@query("""
WITH numbered AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS r FROM orders),
batched AS (SELECT o_orderkey, (r // 500) * 2 + CASE WHEN r % 500 < 175 THEN 0 ELSE 1 END AS b FROM numbered),
sizes AS (SELECT b, count(*) AS n FROM batched GROUP BY 1)
SELECT o_orderkey, CASE WHEN n < 150 AND n < (CASE b % 2 WHEN 0 THEN 175 ELSE 325 END) THEN NULL ELSE b END AS batch_no
FROM batched JOIN sizes USING (b)""")
def rotating_batches(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderdate", "o_orderkey")
    return batching.rotating_batches(rows, ["o_orderdate", "o_orderkey"], [175, 325], 150).select("o_orderkey", "batch_no")


@query("""
WITH RECURSIVE e AS (SELECT event_id, epoch_us(ts) AS seen, row_number() OVER (ORDER BY ts, event_id) AS r FROM events),
walk AS (
  SELECT r, event_id, seen AS first_at, 1 AS held, 0 AS batch_no FROM e WHERE r = 1
  UNION ALL
  SELECT e.r, e.event_id, CASE WHEN w.held >= 20 OR e.seen - w.first_at >= 3600000000 THEN e.seen ELSE w.first_at END,
         CASE WHEN w.held >= 20 OR e.seen - w.first_at >= 3600000000 THEN 1 ELSE w.held + 1 END,
         CASE WHEN w.held >= 20 OR e.seen - w.first_at >= 3600000000 THEN w.batch_no + 1 ELSE w.batch_no END
  FROM walk w JOIN e ON e.r = w.r + 1)
SELECT event_id, CAST(batch_no AS BIGINT) AS batch_no FROM walk""")
def size_or_time_batches(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts")
    return batching.size_or_time_batches(rows, "ts", "event_id", 20, 3600).select("event_id", "batch_no")


@query("""
WITH map AS (SELECT n_regionkey AS code, list(n_name ORDER BY n_name) AS classes FROM nation WHERE n_regionkey <> 3 GROUP BY 1)
SELECT s_suppkey AS slide_id, array_to_string(coalesce(m.classes, ['invasive carcinoma', 'stroma', 'other']), '|') AS classes
FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN map m ON m.code = n_regionkey""")
def slide_class_lists(t: Tables) -> DataFrame:
    """Class names of each slide's code, with the default list for a code that has none."""
    nation = t.nation
    classes = nation.where("n_regionkey <> 3").select(F.col("n_regionkey").alias("oncotree_code"), F.col("n_name").alias("class"))
    slides = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("slide_id"), F.col("n_regionkey").alias("oncotree_code"))
    return embed.slide_classes(slides, classes, rules.DEFAULT_CLASSES).select("slide_id", F.array_join("classes", "|").alias("classes"))


@query("""
WITH groups AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey AS sample_id, o_orderkey FROM orders JOIN groups USING (o_custkey) JOIN customer ON c_custkey = o_custkey
WHERE groups.n >= 8 + c_nationkey % 6""")
def complete_groups(t: Tables) -> DataFrame:
    """Slides of the samples whose expected number has arrived."""
    expected = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.lit(8) + F.col("c_nationkey") % 6).alias("n"))
    rows = t.orders.join(expected, "o_custkey").select(F.col("o_custkey").alias("sample_id"), "o_orderkey", "n")
    return manifest.complete_groups(rows, "sample_id", "o_orderkey", "n")


@query("""
SELECT page_id, CASE WHEN NOT regexp_matches(url, '^\\S+$') THEN 1 ELSE 0 END
       + CASE WHEN NOT regexp_matches(lower(url || '.svs'), '^\\S+\\.(svs|tiff|tif|ndpi|scn)$') OR length(html) < 1500 THEN 1 ELSE 0 END AS n_reasons
FROM pages""")
def sheet_validation(t: Tables) -> DataFrame:
    suffix = F.when(F.length("html") < 1500, ".jpg").otherwise(".svs")
    rows = t.pages.select("page_id", F.col("url").alias("slide_id"), F.concat("url", suffix).alias("slide_path"))
    return quality.check_sheet(rows).select("page_id", F.size("reasons").alias("n_reasons"))


@query("""
SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)', 1) AS bucket,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?(.*)$', 1) AS key FROM pages""")
def uri_parts(t: Tables) -> DataFrame:
    scheme, bucket, key = names.split_uri(F.col("url"))
    return t.pages.select("page_id", scheme.alias("scheme"), bucket.alias("bucket"), key.alias("key"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::VARCHAR AS shipped,
       CAST(l_partkey * l_quantity * 10 AS BIGINT) AS seconds,
       CASE WHEN l_partkey * l_quantity * 10 < 60 THEN '<1m'
            WHEN l_partkey * l_quantity * 10 >= 86400
            THEN (CAST(l_partkey * l_quantity * 10 AS BIGINT) // 86400) || 'd ' || (CAST(l_partkey * l_quantity * 10 AS BIGINT) // 3600 % 24) || 'h ' || (CAST(l_partkey * l_quantity * 10 AS BIGINT) // 60 % 60) || 'm'
            ELSE (CAST(l_partkey * l_quantity * 10 AS BIGINT) // 3600) || 'h ' || (CAST(l_partkey * l_quantity * 10 AS BIGINT) // 60 % 60) || 'm' END AS pretty
FROM lineitem""")
def elapsed_text(t: Tables) -> DataFrame:
    """Durations written as scheduler text, read back and printed."""
    s = (F.col("l_partkey") * F.col("l_quantity") * 10).cast("bigint")
    days = F.floor(s / 86400)
    clock = F.format_string("%02d:%02d:%02d", F.floor(s / 3600) % 24, F.floor(s / 60) % 60, s % 60)
    written = F.when(days > 0, F.concat(days.cast("string"), F.lit("-"), clock)).otherwise(clock)
    read = t.lineitem.withColumn("written", written).withColumn("seconds", names.elapsed_seconds(F.col("written")))
    return read.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
        "seconds", names.pretty_duration(F.col("seconds")).alias("pretty"))


@query("""
SELECT s_suppkey, lower(model) AS encoder, precision, batch_size FROM (
  SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'gigapath' WHEN 1 THEN 'clip' ELSE 'optimus' END AS model,
         CASE s_suppkey % 3 WHEN 2 THEN 'float16' ELSE 'float32' END AS precision,
         CASE s_suppkey % 3 WHEN 0 THEN 32 ELSE 64 END AS batch_size FROM supplier)""")
def encoder_settings(t: Tables) -> DataFrame:
    """Patch encoder, precision and batch size resolved per configured model."""
    model = F.when(F.col("s_suppkey") % 3 == 0, "gigapath_slide").when(F.col("s_suppkey") % 3 == 1, "madeleine_slide").otherwise("optimus")
    encoder = rules.patch_encoder(model)
    return t.supplier.select("s_suppkey", encoder.alias("encoder"),
                             rules.resolve_precision(encoder, {"optimus": "float16"}).alias("precision"),
                             rules.resolve_batch_size(encoder, {"GigaPath": 32}).alias("batch_size"))


@query("""
SELECT 'S' || s_suppkey AS slide_id, 'w' AS workflow_id, unnest(['native_mpp', 'mpp_is_fallback']) AS key,
       unnest([CASE WHEN s_nationkey < 5 THEN 'unknown' WHEN s_nationkey < 15 THEN '0.25' ELSE '0.5' END, CASE WHEN s_nationkey < 5 THEN 'unknown' ELSE 'false' END]) AS value FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 'w', 'tiles_h5_path', 'tiles/' || s_name FROM supplier WHERE s_acctbal > 0""")
def grid_attributes(t: Tables) -> DataFrame:
    known = F.col("s_nationkey") >= 5
    meta = t.supplier.select(F.concat(F.lit("S"), "s_suppkey").alias("slide_id"),
                             F.when(known, F.when(F.col("s_nationkey") < 15, 0.25).otherwise(0.5)).alias("native_mpp"),
                             F.when(known, False).alias("mpp_is_fallback"),
                             F.when(F.col("s_acctbal") > 0, F.concat(F.lit("tiles/"), "s_name")).alias("tiles_h5_path"))
    return manifest.grid_attributes(meta, "w", ["tiles_h5_path"])


@query("SELECT lang AS model, count(*) AS n_files FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1")
def intermediate_models(t: Tables) -> DataFrame:
    return manifest.intermediate_models(t.documents.select(F.col("lang").alias("model")), ["en", "fr"])


@query("""
SELECT l_orderkey, l_partkey AS slide_id, l_suppkey AS output, p_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <= 40""")
def transposed_outputs(t: Tables) -> DataFrame:
    """List columns of a batch turned into rows and matched to their slides by id, unmatched ones dropped."""
    lists = t.lineitem.select("l_orderkey", F.array("l_partkey").alias("slide_id"), F.array("l_suppkey").alias("output"))
    meta = t.part.where("p_size <= 40").select(F.col("p_partkey").alias("slide_id"), "p_name")
    return batching.attach_metadata(batching.transpose(lists, ["slide_id", "output"]), meta).select("l_orderkey", "slide_id", "output", "p_name")
