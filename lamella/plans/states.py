"""State table, merge and progress queries. ``orders`` stands in for the slide state table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import numeric
from lamella.functions import text as names
from lamella.operators import merge, progress, resolve, state, status
from lamella.plans.catalog import Tables, query, second, text, ts

NOW = "2001-10-01 00:00:00"

# Slide state: one row per order. Slide ids repeat (one per customer), paths do not.
_STATE_SQL = """
slides AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'gdc://' || o_orderkey || '/f' || o_orderkey
              WHEN o_orderpriority = '2-HIGH' THEN 's3://b/' || o_orderkey ELSE '/d/' || o_orderkey END AS slide_path,
         'S' || o_custkey AS slide_id,
         CASE WHEN o_orderstatus = 'O' THEN 'PENDING' WHEN o_orderstatus = 'P' THEN 'DISPATCHED'
              WHEN o_totalprice < 250000 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
         CASE WHEN o_orderstatus <> 'O' THEN 'B' || (o_custkey // 10) END AS batch_id,
         CAST(floor(o_totalprice / 100000) AS INTEGER) AS fail_count,
         CASE WHEN o_orderstatus = 'F' AND o_totalprice < 250000 THEN 'err ' || o_orderpriority END AS error_msg,
         o_orderdate AS first_seen_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS completed_at,
         o_custkey, o_orderkey
  FROM orders)
"""


def _state(t: Tables) -> DataFrame:
    path = (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("gdc://"), "o_orderkey", F.lit("/f"), "o_orderkey"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("s3://b/"), "o_orderkey"))
            .otherwise(F.concat(F.lit("/d/"), "o_orderkey")))
    finished = F.col("o_orderstatus") == "F"
    failed = finished & (F.col("o_totalprice") < 250000)
    none = F.lit(None).cast("string")
    return t.orders.select(
        path.alias("slide_path"), F.concat(F.lit("S"), "o_custkey").alias("slide_id"), F.lit("").alias("oncotree_code"),
        F.when(F.col("o_orderstatus") == "O", "PENDING").when(F.col("o_orderstatus") == "P", "DISPATCHED")
         .when(failed, "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("B"), F.floor(F.col("o_custkey") / 10))).alias("batch_id"),
        none.alias("download_path"), F.floor(F.col("o_totalprice") / 100000).cast("int").alias("fail_count"),
        ts("o_orderdate").alias("first_seen_at"), F.when(F.col("o_orderstatus") != "O", ts("o_orderdate")).alias("dispatched_at"),
        F.when(finished, ts("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("completed_at"),
        F.when(failed, F.concat(F.lit("err "), "o_orderpriority")).alias("error_msg"), none.alias("file_id"), none.alias("file_name"),
        (F.col("o_orderpriority") == "1-URGENT").alias("needs_download"))


_SHOWN = ["slide_path", "slide_id", "status", "batch_id", "fail_count", "error_msg"]
_NOW = f"TIMESTAMP '{NOW}'"


def _now():
    return F.lit(NOW).cast("timestamp")


@query(f"WITH {_STATE_SQL} SELECT status, count(*) AS n FROM slides GROUP BY 1")
def count_by_status(t: Tables) -> DataFrame:
    return progress.count_by_status(_state(t))


@query(f"""
WITH {_STATE_SQL},
wanted AS (SELECT slide_path, 'N' || (o_custkey // 100) AS b FROM slides WHERE fail_count >= 1),
claimed AS (
  SELECT s.*, w.b FROM slides s LEFT JOIN wanted w USING (slide_path))
SELECT slide_path, slide_id, CASE WHEN b IS NOT NULL AND status = 'PENDING' THEN 'DISPATCHED' ELSE status END AS status,
       CASE WHEN b IS NOT NULL AND status = 'PENDING' THEN b ELSE batch_id END AS batch_id, fail_count, error_msg FROM claimed""")
def claim_slides(t: Tables) -> DataFrame:
    current = _state(t)
    customer = F.substring("slide_id", 2, 20).cast("bigint")
    wanted = current.where("fail_count >= 1").select("slide_path", F.concat(F.lit("N"), F.floor(customer / 100)).alias("batch_id"))
    return state.claim(current, wanted, _now()).select(*_SHOWN)


@query(f"""
WITH {_STATE_SQL},
results AS (SELECT 'B' || s_suppkey AS b, CASE WHEN s_acctbal < 3000 THEN 1 WHEN s_acctbal < 5000 THEN 137 ELSE 0 END AS code,
                   CASE WHEN s_acctbal < 3000 THEN 20.0 ELSE 900.0 END AS took FROM supplier),
joined AS (SELECT s.*, code, took FROM slides s LEFT JOIN results ON b = batch_id)
SELECT slide_path, slide_id,
       CASE WHEN status = 'DISPATCHED' AND code = 0 THEN 'SUCCEEDED' WHEN status = 'DISPATCHED' AND code <> 0 AND took >= 60 THEN 'FAILED'
            WHEN status = 'DISPATCHED' AND code <> 0 THEN 'PENDING' ELSE status END AS status,
       CASE WHEN status = 'DISPATCHED' AND code <> 0 AND took < 60 THEN NULL ELSE batch_id END AS batch_id,
       CASE WHEN code <> 0 AND took >= 60 AND status IN ('DISPATCHED', 'FAILED') THEN fail_count + 1 ELSE fail_count END AS fail_count,
       error_msg,
       strftime(CASE WHEN status = 'DISPATCHED' AND (code = 0 OR took >= 60) THEN {_NOW} ELSE completed_at END, '%Y-%m-%d %H:%M:%S') AS completed_at
FROM joined""")
def complete_batches(t: Tables) -> DataFrame:
    low, mid = F.col("s_acctbal") < 3000, F.col("s_acctbal") < 5000
    results = t.supplier.select(F.concat(F.lit("B"), "s_suppkey").alias("batch_id"),
                                F.when(low, 1).when(mid, 137).otherwise(0).alias("exit_code"),
                                F.when(low, 20.0).otherwise(900.0).alias("duration_s"))
    done = state.complete_batches(_state(t), results, _now())
    return done.select(*_SHOWN, second(F.col("completed_at")).alias("completed_at"))


@query(f"""
WITH {_STATE_SQL},
results AS (SELECT slide_path, batch_id, fail_count < 3 AS good FROM slides WHERE fail_count <> 1 AND batch_id IS NOT NULL)
SELECT s.slide_path, slide_id, CASE WHEN good IS NULL THEN status WHEN good THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
       s.batch_id, fail_count, error_msg FROM slides s LEFT JOIN results r ON r.slide_path = s.slide_path AND r.batch_id = s.batch_id""")
def complete_slides(t: Tables) -> DataFrame:
    current = _state(t)
    results = current.where("fail_count <> 1 AND batch_id IS NOT NULL").select("slide_path", "batch_id", (F.col("fail_count") < 3).alias("ok"))
    return state.complete_slides(current, results, _now()).select(*_SHOWN)


@query(f"""
WITH {_STATE_SQL}
SELECT slide_path, slide_id, CASE WHEN status = 'FAILED' AND fail_count < 2 THEN 'PENDING' ELSE status END AS status,
       CASE WHEN status = 'FAILED' AND fail_count < 2 THEN NULL ELSE batch_id END AS batch_id, fail_count,
       CASE WHEN status = 'FAILED' AND fail_count < 2 THEN NULL ELSE error_msg END AS error_msg FROM slides""")
def retry_reset(t: Tables) -> DataFrame:
    return state.retry_failed(_state(t), 2).select(*_SHOWN)


@query(f"""
WITH {_STATE_SQL}, lost AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45)
SELECT slide_path, slide_id, CASE WHEN status = 'SUCCEEDED' AND l_orderkey IS NOT NULL THEN 'PENDING' ELSE status END AS status,
       CASE WHEN status = 'SUCCEEDED' AND l_orderkey IS NOT NULL THEN NULL ELSE batch_id END AS batch_id,
       CASE WHEN status = 'SUCCEEDED' AND l_orderkey IS NOT NULL THEN 0 ELSE fail_count END AS fail_count, error_msg
FROM slides LEFT JOIN lost ON l_orderkey = o_orderkey""")
def requeue_lost(t: Tables) -> DataFrame:
    lost = t.lineitem.where("l_quantity > 45").select(F.explode(F.array(*[
        F.concat(F.lit(p), "l_orderkey", *s) for p, s in (("s3://b/", []), ("/d/", []), ("gdc://", [F.lit("/f"), "l_orderkey"]))])).alias("slide_path"))
    return state.requeue_lost(_state(t), lost).select(*_SHOWN)


@query(f"""
WITH {_STATE_SQL},
listed AS (SELECT 'S' || CASE WHEN c_acctbal > 9000 THEN c_custkey + 10000000 ELSE c_custkey END AS slide_id, 'bad ' || c_mktsegment AS reason
           FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000)
SELECT coalesce(slide_path, 'tombstone://' || slide_id) AS slide_path, slide_id,
       CASE WHEN reason IS NOT NULL THEN 'FAILED' ELSE status END AS status,
       CASE WHEN reason IS NOT NULL THEN NULL ELSE batch_id END AS batch_id,
       CASE WHEN reason IS NOT NULL THEN 999 ELSE fail_count END AS fail_count, coalesce(reason, error_msg) AS error_msg
FROM slides FULL OUTER JOIN listed USING (slide_id)""")
def blacklist_upsert(t: Tables) -> DataFrame:
    unknown = F.col("c_acctbal") > 9000
    listed = t.customer.where("c_acctbal < 0 OR c_acctbal > 9000").select(
        F.concat(F.lit("S"), F.when(unknown, F.col("c_custkey") + 10000000).otherwise(F.col("c_custkey"))).alias("slide_id"),
        F.concat(F.lit("bad "), "c_mktsegment").alias("reason"))
    return state.blacklist(_state(t), listed, _now()).select(*_SHOWN)


_COVERAGE_SQL = """
covered AS (
  SELECT 'S' || o_custkey AS slide_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_returnflag IN ('A', 'N') AND l_quantity < 25 GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 2),
missing AS (SELECT DISTINCT slide_id FROM slides WHERE slide_id NOT IN (SELECT slide_id FROM covered))
"""


def _uncovered(t: Tables) -> DataFrame:
    entries = t.lineitem.where("l_quantity < 25").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("S"), "o_custkey").alias("slide_id"), F.col("l_returnflag").alias("model"))
    return state.uncovered(_state(t), entries, ["A", "N"])


@query(f"WITH {_STATE_SQL}, {_COVERAGE_SQL} SELECT slide_id FROM missing")
def coverage_missing(t: Tables) -> DataFrame:
    return _uncovered(t)


@query(f"""
WITH {_STATE_SQL}, {_COVERAGE_SQL},
flagged AS (SELECT s.*, m.slide_id IS NOT NULL AND status = 'SUCCEEDED' AS hit FROM slides s LEFT JOIN missing m USING (slide_id))
SELECT slide_path, slide_id, CASE WHEN hit AND fail_count + 1 >= 4 THEN 'FAILED' WHEN hit THEN 'PENDING' ELSE status END AS status,
       CASE WHEN hit THEN NULL ELSE batch_id END AS batch_id, CASE WHEN hit THEN fail_count + 1 ELSE fail_count END AS fail_count,
       CASE WHEN hit AND fail_count + 1 >= 4 THEN '{state.MISSING_SHARDS}' ELSE error_msg END AS error_msg FROM flagged""")
def coverage_reset(t: Tables) -> DataFrame:
    return state.apply_coverage(_state(t), _uncovered(t), 4).select(*_SHOWN)


@query(f"""
WITH {_STATE_SQL},
flags AS (
  SELECT slide_id, bool_or(status = 'SUCCEEDED' OR (status IN ('PENDING', 'DISPATCHED') AND slide_path NOT LIKE 'gdc://%') OR fail_count >= 5) AS blocked
  FROM slides GROUP BY 1)
SELECT 'gdc://' || c_custkey || '/' || c_name AS slide_path, 'S' || c_custkey AS slide_id
FROM customer LEFT JOIN flags f ON f.slide_id = 'S' || c_custkey
WHERE NOT coalesce(blocked, FALSE) AND c_mktsegment <> 'BUILDING'
  AND 'gdc://' || c_custkey || '/' || c_name NOT IN (SELECT slide_path FROM slides)""")
def admit_downloads(t: Tables) -> DataFrame:
    wanted = t.customer.select(F.concat(F.lit("S"), "c_custkey").alias("slide_id"), text("c_custkey").alias("file_id"),
                               F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("file_name"))
    return resolve.admit_downloads(wanted, _state(t), 5).select("slide_path", "slide_id")


@query(f"""
WITH {_STATE_SQL}, queued AS (SELECT 'S' || c_custkey AS slide_id FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT slide_path, slide_id, status FROM slides
WHERE NOT (slide_path LIKE 's3://%' AND status IN ('PENDING', 'FAILED') AND slide_id IN (SELECT slide_id FROM queued))""")
def drop_stale_remote(t: Tables) -> DataFrame:
    queued = t.customer.where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("S"), "c_custkey").alias("slide_id"))
    return state.drop_stale_remote(_state(t), queued).select("slide_path", "slide_id", "status")


@query(f"""
WITH {_STATE_SQL}, arrivals AS (SELECT '/d/' || l_orderkey AS slide_path, min('L' || l_suppkey) AS slide_id FROM lineitem GROUP BY 1)
SELECT slide_path, slide_id, status, fail_count FROM slides
UNION ALL SELECT slide_path, slide_id, 'PENDING', 0 FROM arrivals WHERE slide_path NOT IN (SELECT slide_path FROM slides)""")
def insert_new_slides(t: Tables) -> DataFrame:
    arrivals = t.lineitem.select(F.concat(F.lit("/d/"), "l_orderkey").alias("slide_path"), F.concat(F.lit("L"), "l_suppkey").alias("slide_id"))
    return state.insert_new(_state(t), arrivals, _now()).select("slide_path", "slide_id", "status", "fail_count")


@query(f"""
WITH {_STATE_SQL}
SELECT slide_path, slide_id, CASE WHEN slide_path LIKE 'gdc://%' THEN split_part(slide_path, '/', 3) END AS file_id,
       CASE WHEN slide_path LIKE 'gdc://%' THEN split_part(slide_path, '/', 4) END AS file_name
FROM slides WHERE status = 'PENDING' AND slide_id NOT IN (SELECT 'S' || c_custkey FROM customer WHERE c_acctbal < 1000)""")
def requeueable_slides(t: Tables) -> DataFrame:
    flying = t.customer.where("c_acctbal < 1000").select(F.concat(F.lit("S"), "c_custkey").alias("slide_id"))
    return state.requeueable(_state(t), flying).select("slide_path", "slide_id", "file_id", "file_name")


@query(f"""
WITH {_STATE_SQL},
latest AS (SELECT slide_id, arg_max(struct_pack(status, error_msg, slide_path), (first_seen_at, slide_path)) AS r FROM slides GROUP BY 1),
shards AS (SELECT 'S' || o_custkey AS slide_id, l_returnflag AS model, max('s3://w/' || l_suppkey) AS wds_path
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT slide_id, r.slide_path AS slide_path, model, CASE WHEN r.status = 'DISPATCHED' THEN 'PENDING' ELSE r.status END AS status,
       CASE WHEN r.status = 'FAILED' THEN coalesce(r.error_msg, '') ELSE '' END AS failure_reason, coalesce(wds_path, '') AS wds_path
FROM latest CROSS JOIN (SELECT unnest(['A', 'N', 'R']) AS model) LEFT JOIN shards USING (slide_id, model)""")
def state_export(t: Tables) -> DataFrame:
    shards = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("S"), "o_custkey").alias("slide_id"), F.col("l_returnflag").alias("model"),
        F.concat(F.lit("s3://w/"), "l_suppkey").alias("wds_path"))
    models = status.models_or_unknown(shards, None)
    exported = status.export_from_state(_state(t), shards, models, F.struct("first_seen_at", "slide_path"))
    return exported.select("slide_id", "slide_path", "model", "status", "failure_reason", "wds_path")


# Batches: one per order ----------------------------------------------------------

_BATCH_SQL = """
batches AS (
  SELECT strftime(o_orderdate, '%Y%m%dT%H%M%S') || '_' || lpad(lower(to_hex(o_orderkey)), 8, '0') AS batch_id,
         CASE o_orderstatus WHEN 'P' THEN 'RUNNING' WHEN 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS pid, o_orderpriority <> '4-NOT SPECIFIED' AS alive,
         o_totalprice > 30000 AS resumable, o_orderkey, o_orderdate, o_totalprice FROM orders)
"""


def _batches(t: Tables) -> DataFrame:
    batch = F.concat(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), F.lit("_"), F.lpad(F.lower(F.hex("o_orderkey")), 8, "0"))
    low = F.col("o_orderpriority") == "5-LOW"
    return t.orders.select(
        batch.alias("batch_id"),
        F.when(F.col("o_orderstatus") == "P", "RUNNING").when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.when(~low, F.col("o_custkey")).alias("pid"), (F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("alive"),
        (F.col("o_totalprice") > 30000).alias("resumable"), ts("o_orderdate").alias("dispatched_at"),
        F.when(F.col("o_orderstatus") != "P", ts("o_orderdate") + F.expr("INTERVAL 90 MINUTES")).alias("completed_at"),
        F.lit(None).cast("int").alias("exit_code"), F.concat(F.lit("/log/"), "o_orderkey").alias("log_path"),
        F.concat(F.lit("/work/"), "o_orderkey").alias("work_dir"), F.lit(None).cast("string").alias("session_id"))


@query(f"""
WITH {_BATCH_SQL},
keep AS (SELECT batch_id FROM batches WHERE status = 'RUNNING' AND alive AND pid IS NOT NULL AND resumable
           AND o_orderdate + INTERVAL 24 HOUR >= TIMESTAMP '2000-06-01' ORDER BY batch_id LIMIT 100)
SELECT batch_id, CASE WHEN status <> 'RUNNING' THEN NULL WHEN batch_id IN (SELECT batch_id FROM keep) THEN 'resume' ELSE 'reset' END AS recovery
FROM batches""")
def recover_batches(t: Tables) -> DataFrame:
    """Stale, dead and excess running batches are reset; the first hundred live ones resume (the operator's cap)."""
    now = F.lit("2000-06-01").cast("timestamp")
    return state.recover_batches(_batches(t), now, 100).select("batch_id", "recovery")


@query(f"""
WITH {_BATCH_SQL},
results AS (SELECT batch_id, CAST(CASE WHEN o_totalprice < 100000 THEN 1 ELSE 0 END AS INTEGER) AS code FROM batches WHERE status = 'RUNNING' AND o_totalprice < 300000),
marked AS (SELECT b.batch_id, CASE WHEN code IS NULL THEN status WHEN code = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, code, o_totalprice
           FROM batches b LEFT JOIN results USING (batch_id))
SELECT batch_id, status, code AS exit_code, CASE WHEN o_totalprice > 400000 THEN 'session' END AS session_id FROM marked WHERE o_totalprice >= 20000""")
def batch_rows(t: Tables) -> DataFrame:
    """Batch completion, cancellation and attributes over the batch table."""
    base = _batches(t).withColumn("price", F.lit(0.0)).drop("price")
    priced = t.orders.select(
        F.concat(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), F.lit("_"), F.lpad(F.lower(F.hex("o_orderkey")), 8, "0")).alias("batch_id"),
        "o_totalprice", "o_orderstatus")
    results = priced.where("o_orderstatus = 'P' AND o_totalprice < 300000").select(
        "batch_id", F.when(F.col("o_totalprice") < 100000, 1).otherwise(0).alias("exit_code"))
    done = state.finish_batches(base, results, _now())
    kept = state.cancel_batches(done, priced.where("o_totalprice < 20000"))
    sessions = priced.where("o_totalprice > 400000").select("batch_id", F.lit("session").alias("session_id"))
    return state.set_attributes(kept, sessions, "batch_id").select("batch_id", "status", "exit_code", "session_id")


@query(f"""
WITH {_BATCH_SQL}
SELECT batch_id, '/log/' || o_orderkey AS log_path FROM batches
WHERE status = 'SUCCEEDED' AND o_orderdate + INTERVAL 90 MINUTE < TIMESTAMP '2000-06-01' - INTERVAL 30 DAY""")
def old_batch_logs(t: Tables) -> DataFrame:
    return state.old_batch_logs(_batches(t), F.lit("2000-06-01").cast("timestamp"), 30)


@query(f"""
WITH {_BATCH_SQL}
SELECT batch_id, status, CAST(CASE WHEN status <> 'RUNNING' THEN 5400 END AS BIGINT) AS duration_s FROM batches
ORDER BY o_orderdate DESC, batch_id LIMIT 30""")
def recent_batches(t: Tables) -> DataFrame:
    """The last thirty batches: a top-k report."""
    return progress.recent_batches(_batches(t)).select("batch_id", "status", "duration_s")


@query(f"""
WITH {_BATCH_SQL}
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'dispatcher_r' || lpad(lower(to_hex(o_orderkey)), 8, '0') WHEN 1 THEN lpad(lower(to_hex(o_orderkey)), 8, '0')
            ELSE 'dispatcher_' || batch_id END AS run_name, batch_id FROM batches""")
def runs_with_batches(t: Tables) -> DataFrame:
    """Run names of three forms matched to their batches."""
    known = _batches(t)
    suffix = F.substring_index("batch_id", "_", -1)
    number = F.substring_index("log_path", "/", -1).cast("bigint") % 3
    runs = known.select(F.when(number == 0, F.concat(F.lit("dispatcher_r"), suffix)).when(number == 1, suffix)
                        .otherwise(F.concat(F.lit("dispatcher_"), "batch_id")).alias("run_name"))
    return progress.runs_with_batches(runs, known)


@query("""
WITH stored AS (SELECT 'B' || o_custkey AS batch_id, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done,
                       count(*) FILTER (o_orderpriority = '5-LOW') AS failed FROM orders GROUP BY 1),
have AS (SELECT 'B' || c_custkey AS batch_id FROM customer WHERE c_acctbal > 5000)
SELECT batch_id, 0 AS succeeded, 0 AS failed, 0 AS pending FROM have
UNION ALL SELECT batch_id, done, failed, greatest(0, total - done - failed) FROM stored WHERE batch_id NOT IN (SELECT batch_id FROM have)""")
def progress_backfill(t: Tables) -> DataFrame:
    stored = t.orders.groupBy(F.concat(F.lit("B"), "o_custkey").alias("batch_id")).agg(
        F.count("*").alias("tasks_total"), F.count_if(F.col("o_orderstatus") == "F").alias("tasks_done"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("tasks_failed"))
    zero = F.lit(0).cast("bigint")
    have = t.customer.where("c_acctbal > 5000").select(F.concat(F.lit("B"), "c_custkey").alias("batch_id"),
                                                       zero.alias("succeeded"), zero.alias("failed"), zero.alias("pending"))
    return state.backfill_progress(stored, have)


# Merge ---------------------------------------------------------------------------

_CUSTOMERS_SQL = """
target AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'kept' AS note FROM customer WHERE c_mktsegment <> 'BUILDING'),
source AS (SELECT c_custkey, c_nationkey, c_name || '*' AS c_name, c_mktsegment FROM customer WHERE c_acctbal >= 0)
"""


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.lit("kept").alias("note"))
    source = t.customer.where("c_acctbal >= 0").select("c_custkey", "c_nationkey", F.concat("c_name", F.lit("*")).alias("c_name"), "c_mktsegment")
    return target, source


@query(f"""
WITH {_CUSTOMERS_SQL}
SELECT s.c_custkey, s.c_nationkey, s.c_name, c_acctbal, note, s.c_mktsegment FROM source s LEFT JOIN target t USING (c_custkey, c_nationkey)""")
def merge_delete_missing(t: Tables) -> DataFrame:
    """Update, insert and delete by composite key, adding the source's new column."""
    return merge.merge(*_merge_sides(t), ["c_custkey", "c_nationkey"])


@query(f"""
WITH {_CUSTOMERS_SQL}
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(t.c_nationkey, s.c_nationkey) AS c_nationkey,
       coalesce(s.c_name, t.c_name) AS c_name, c_acctbal, note
FROM target t FULL OUTER JOIN source s ON s.c_custkey = t.c_custkey AND s.c_nationkey = t.c_nationkey""")
def merge_intersection(t: Tables) -> DataFrame:
    """Common columns only, keeping unmatched target rows."""
    return merge.merge(*_merge_sides(t), ["c_custkey", "c_nationkey"], delete_missing=False, evolve=False)


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    return merge.latest_per_key(rows, ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM lineitem) AS target_rows")
def audit_counts(t: Tables) -> DataFrame:
    return merge.audit_counts(t.orders, t.lineitem)


# Progress --------------------------------------------------------------------------

@query("""
WITH w AS (
  SELECT count(*) FILTER (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-06-30' - INTERVAL 720 HOUR AND o_orderdate <= TIMESTAMP '2001-06-30') AS n,
         min(o_orderdate) FILTER (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-06-30' - INTERVAL 720 HOUR AND o_orderdate <= TIMESTAMP '2001-06-30') AS t0,
         count(*) FILTER (o_orderstatus IN ('O', 'P')) AS waiting FROM orders),
inv AS (SELECT greatest(0, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders)) AS more),
r AS (SELECT n, waiting + more AS remaining,
             CASE WHEN n >= 2 AND epoch(TIMESTAMP '2001-06-30') - epoch(t0) > 60
                  THEN round(n / (least(epoch(TIMESTAMP '2001-06-30') - epoch(t0), 720 * 3600.0) / 3600), 1) END AS rate FROM w, inv)
SELECT n AS completed_in_window, rate AS throughput_per_hour, remaining, CAST(round(remaining / nullif(rate, 0) * 3600) AS BIGINT) AS eta_seconds FROM r""")
def throughput_eta(t: Tables) -> DataFrame:
    slides = t.orders.select(F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "O", "PENDING")
                             .otherwise("DISPATCHED").alias("status"), ts("o_orderdate").alias("completed_at"))
    more = progress.undispatched(t.lineitem, t.orders).select("n_undispatched").scalar()
    figures = progress.throughput(slides, F.lit("2001-06-30").cast("timestamp"), 720, more)
    return figures.select("completed_in_window", "throughput_per_hour", "remaining", "eta_seconds")


@query("""
SELECT (SELECT count(*) FROM lineitem) AS n_inventory, (SELECT count(*) FROM orders) AS n_known,
       greatest(0, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders)) AS n_undispatched""")
def undispatched(t: Tables) -> DataFrame:
    return progress.undispatched(t.lineitem, t.orders)


_JOBS_SQL = """
jobs AS (
  SELECT event_id, event_type, user_id, value, CAST(floor(value * 100) AS BIGINT) AS seconds,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE '20240101T000000_' || lpad(lower(to_hex(user_id)), 8, '0') END AS batch_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'RUNNING' WHEN event_type = 'signup' THEN 'PENDING' ELSE 'COMPLETING' END AS state FROM events)
"""


def _jobs(t: Tables) -> DataFrame:
    s = (F.col("value") * 100).cast("bigint")
    clock = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    state_ = F.when(F.col("event_type").isin("click", "view"), "RUNNING").when(F.col("event_type") == "signup", "PENDING").otherwise("COMPLETING")
    workdir = F.when(F.col("user_id") % 7 == 0, "/home/x").otherwise(
        F.concat(F.lit("/work/batch_20240101T000000_"), F.lpad(F.lower(F.hex("user_id")), 8, "0"), F.lit("/ab")))
    return t.events.select(text("event_id").alias("job_id"), F.concat(F.lit("nf-STEP_"), "event_type", F.lit(" ("), "event_id", F.lit(")")).alias("name"),
                           state_.alias("state"), F.lit("(Priority)").alias("reason"), F.concat(F.lit("gpu"), F.col("event_id") % 11).alias("node"),
                           workdir.alias("workdir"), clock.alias("elapsed"))


@query(f"""
WITH {_JOBS_SQL}
SELECT batch_id, 'STEP_' || event_type AS process, count(*) FILTER (state = 'RUNNING') AS n_running, count(*) FILTER (state = 'PENDING') AS n_pending,
       count(DISTINCT event_id % 11) FILTER (state = 'RUNNING') AS n_nodes, max(seconds) FILTER (state = 'RUNNING') AS max_elapsed_s,
       count(*) FILTER (state = 'RUNNING' AND seconds > 7200) AS n_stalled
FROM jobs GROUP BY 1, 2""")
def job_rollup(t: Tables) -> DataFrame:
    return progress.job_rollup(_jobs(t))


@query(f"WITH {_JOBS_SQL} SELECT CAST(event_id AS VARCHAR) AS job_id, seconds AS elapsed_s, batch_id FROM jobs WHERE state = 'RUNNING' AND seconds > 7200")
def stalled_jobs(t: Tables) -> DataFrame:
    return progress.stalled_jobs(_jobs(t)).select("job_id", "elapsed_s", "batch_id")


@query("SELECT 'Priority' AS reason, count(*) AS n FROM events WHERE event_type = 'signup'")
def pending_reasons(t: Tables) -> DataFrame:
    return progress.pending_reasons(_jobs(t))


@query(f"""
WITH {_JOBS_SQL},
per AS (SELECT batch_id, count(*) FILTER (state = 'RUNNING') AS jobs_running, count(*) FILTER (state = 'PENDING') AS jobs_pending FROM jobs GROUP BY 1)
SELECT '20240101T000000_' || lpad(lower(to_hex(c_custkey)), 8, '0') AS batch_id, jobs_running, jobs_pending
FROM customer LEFT JOIN per ON per.batch_id = '20240101T000000_' || lpad(lower(to_hex(c_custkey)), 8, '0')""")
def batches_with_jobs(t: Tables) -> DataFrame:
    known = t.customer.select(F.concat(F.lit("20240101T000000_"), F.lpad(F.lower(F.hex("c_custkey")), 8, "0")).alias("batch_id"))
    return progress.batches_with_jobs(known, _jobs(t)).select("batch_id", "jobs_running", "jobs_pending")


_HISTORY_SQL = """
history AS (
  SELECT CASE event_type WHEN 'view' THEN 'COMPLETED' WHEN 'click' THEN 'FAILED' WHEN 'error' THEN 'CANCELLED by 0' WHEN 'signup' THEN 'TIMEOUT' ELSE 'COMPLETED' END AS state,
         CAST(floor(value * 100) AS BIGINT) AS seconds, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events)
"""


def _history(t: Tables) -> DataFrame:
    s = (F.col("value") * 100).cast("bigint")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    state_ = (F.when(kind == "click", "FAILED").when(kind == "error", "CANCELLED by 0").when(kind == "signup", "TIMEOUT").otherwise("COMPLETED"))
    stderr = (F.when(k < 10, "RuntimeError: CUDA out of memory").when(k < 20, "No space left on device")
              .when(k < 30, "Traceback (most recent call last):").when(k < 40, "read s3://b/k failed: Exception").otherwise(""))
    code = F.when(k < 50, F.lit("1:0")).when(k < 70, F.lit("137:0")).when(k < 80, F.lit("2:0")).otherwise(F.lit("1:0"))
    return t.events.select(state_.alias("state"), code.alias("exit_code"), stderr.alias("stderr"),
                           F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60).alias("elapsed"))


@query(f"""
WITH {_HISTORY_SQL}
SELECT count(*) FILTER (state = 'COMPLETED') AS n_completed, count(*) FILTER (state = 'FAILED') AS n_failed,
       count(*) FILTER (state LIKE 'CANCEL%') AS n_cancelled, count(*) FILTER (state = 'TIMEOUT') AS n_timeout,
       CAST(floor(avg(seconds) FILTER (state = 'COMPLETED')) AS BIGINT) AS avg_elapsed_s,
       min(seconds) FILTER (state = 'COMPLETED') AS min_elapsed_s, max(seconds) FILTER (state = 'COMPLETED') AS max_elapsed_s FROM history""")
def job_history(t: Tables) -> DataFrame:
    return progress.job_history_summary(_history(t))


@query(f"""
WITH {_HISTORY_SQL}
SELECT CASE WHEN k < 10 THEN 'oom_gpu' WHEN k >= 50 AND k < 70 THEN 'oom_host' WHEN state LIKE 'CANCEL%' THEN 'sigterm' WHEN k < 20 THEN 'disk_full'
            WHEN k < 30 THEN 'python_error' WHEN k < 40 THEN 's3_error' WHEN state = 'TIMEOUT' THEN 'timeout'
            WHEN k >= 70 AND k < 80 THEN 'unknown' ELSE 'error_exit1' END AS failure_type, count(*) AS n
FROM history WHERE state <> 'COMPLETED' GROUP BY 1""")
def failure_classes(t: Tables) -> DataFrame:
    return progress.failure_types(_history(t))


@query("""
SELECT user_id, count(*) FILTER (event_type IN ('view', 'click', 'purchase')) AS n_completed, count(*) FILTER (event_type = 'signup') AS n_cached,
       count(*) FILTER (event_type = 'error') AS n_failed, count(*) AS n_total FROM events GROUP BY 1""")
def trace_rollup(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "CACHED").otherwise("COMPLETED")
    return progress.trace_rollup(t.events.withColumn("status", kind), ["user_id"])


@query("SELECT 'TASK (' || event_id || ')' AS name, CAST(value AS VARCHAR) AS exit, props AS hash FROM events WHERE event_type = 'error'")
def trace_failures(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED")
    trace = t.events.select(F.concat(F.lit("TASK ("), "event_id", F.lit(")")).alias("name"), text("value").alias("exit"),
                            F.col("props").alias("hash"), kind.alias("status"))
    return progress.trace_failures(trace)


@query("""
SELECT o_orderpriority, round(100.0 * least(done, total) / total, 1) AS pct_done FROM (
  SELECT o_orderpriority, count(*) FILTER (o_orderstatus <> 'O') AS done, count(*) FILTER (o_orderstatus <> 'P') AS total FROM orders GROUP BY 1)""")
def completion_share(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") != "O").alias("done"),
                                                     F.count_if(F.col("o_orderstatus") != "P").alias("total"))
    return progress.completion(counts, "done", "total").select("o_orderpriority", "pct_done")


@query(f"WITH {_STATE_SQL} SELECT count(*) FILTER (fail_count >= 4) AS n_exhausted FROM slides")
def exhausted_slides(t: Tables) -> DataFrame:
    return progress.exhausted(_state(t), 4)


@query("""
SELECT doc_id, 'executor > local' || chr(10) || replace(text, 'executor >', '') || source AS block FROM documents""")
def progress_blocks(t: Tables) -> DataFrame:
    """Log text with colour codes reduced to its last progress block."""
    log = F.concat(F.lit("\x1b[32mexecutor > old\n\x1b[0mexecutor > local\n\r"), F.replace("text", F.lit("executor >"), F.lit("")), "source")
    return t.documents.select("doc_id", names.last_progress_block(log).alias("block"))


@query("""
SELECT event_id, CASE WHEN abs(d) < 0.001 THEN 'negligible' WHEN abs(d) < 0.01 THEN 'small' ELSE 'large' END AS band
FROM (SELECT event_id, value / 5000 AS d FROM events)""")
def delta_bands(t: Tables) -> DataFrame:
    return t.events.select("event_id", numeric.delta_band(F.col("value") / 5000).alias("band"))
