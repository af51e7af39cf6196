"""Queries over tables that change by versions: buckets rewritten by merges, and state advanced by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions.numeric import portable_hash
from lamella.operators import merge
from lamella.plans.catalog import Tables, hash_sql, query, text
from lamella.session import scratch_dir
from lamella.sinks.buckets import BUCKETS, BucketTable, buckets_for
from lamella.streaming import jobs


@query(f"""
WITH c AS (SELECT c_custkey AS id, c_mktsegment AS segment, 'own-' || c_nationkey AS note, c_nationkey, c_acctbal,
                  {hash_sql('c_custkey')} % {BUCKETS} AS bucket FROM customer),
told AS (SELECT *, bucket = 3 AND c_acctbal < 0 AS updated, bucket = 5 AND c_nationkey % 5 = 2 AS removed FROM c),
seen AS (SELECT *, bool_or(updated) OVER (PARTITION BY bucket) AS v1, bool_or(removed) OVER (PARTITION BY bucket) AS v2 FROM told)
SELECT id, CASE WHEN updated THEN 'REVIEW' ELSE segment END AS segment, note,
       CAST(CASE WHEN v2 THEN 2 WHEN v1 THEN 1 ELSE 0 END AS BIGINT) AS version FROM seen WHERE NOT removed""")
def state_bucket_versions(t: Tables) -> DataFrame:
    """Customers merged twice: an update on the common columns and a merge that deletes. Each rewrites the one bucket it changes;
    ``version`` comes from the path of the file that holds the row."""
    own = t.customer.select(F.col("c_custkey").cast("bigint").alias("id"), text("c_mktsegment").alias("segment"), "c_nationkey", "c_acctbal",
                            (portable_hash(F.col("c_custkey")) % BUCKETS).alias("b"))
    table = BucketTable(t.spark, scratch_dir(t.spark, "buckets"), "id")
    table.create(own.select("id", "segment", F.concat(F.lit("own-"), text("c_nationkey")).alias("note")))
    reviewed = own.where((F.col("b") == 3) & (F.col("c_acctbal") < 0)).select("id", F.lit("REVIEW").alias("segment"), F.lit(1).alias("unknown"))
    table.advance(1, lambda rows: merge.merge(rows, reviewed, ["id"], delete_missing=False, evolve=False), lambda _: reviewed.select("id"))
    left = own.where(~((F.col("b") == 5) & (F.col("c_nationkey") % 5 == 2))).select("id")
    table.advance(2, lambda rows: rows.join(left, "id", "left_semi"))
    return table.read(versions=True)


@query("""
WITH o AS (SELECT *, o_orderkey % 3 AS part FROM orders),
state AS (SELECT 'state' AS kind, 'p' || o_orderkey AS key,
                 CASE WHEN o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderkey % 5 < 3) OR (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
                      THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS value,
                 CAST(CASE WHEN o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') THEN 0 ELSE o_orderkey % 5 END AS BIGINT) AS n
          FROM o),
newest AS (SELECT o_custkey, arg_max(o_orderkey, part * 10000000000 + o_orderkey) AS last, count(*) AS n FROM o GROUP BY 1)
SELECT * FROM state UNION ALL SELECT 'export', CAST(o_custkey AS VARCHAR), CAST(last AS VARCHAR), CAST(last % 3 AS BIGINT) FROM newest""")
def stream_state_tables(t: Tables) -> DataFrame:
    """Orders as a stream of three micro-batches. Each brings new rows into the state, queues failed and lost ones again and merges the
    newest order of each customer into an export, in this order and once."""
    base = scratch_dir(t.spark, "cycle")
    orders = t.orders.select("o_orderkey", "o_custkey", text("o_orderstatus").alias("kind"), (F.col("o_orderpriority") == "1-URGENT").alias("lost"),
                             (F.col("o_orderkey") % 3).alias("part"))
    buckets = buckets_for(orders.count())
    path = F.concat(F.lit("p"), F.col("o_orderkey").cast("string"))
    state = jobs.StateTable(t.spark, f"{base}/state", buckets=buckets)
    state.create(orders.where("kind <> 'P'").select(
        path.alias("slide_path"), F.col("o_orderkey").cast("string").alias("slide_id"),
        F.when(F.col("kind") == "F", "FAILED").otherwise("SUCCEEDED").alias("status"), F.lit("b").alias("batch_id"),
        (F.col("o_orderkey") % 5).cast("int").alias("fail_count"), *[F.lit(None).cast("timestamp").alias(c) for c in ("dispatched_at", "first_seen_at")],
        F.lit("e").alias("error_msg"), F.lit("").alias("oncotree_code"), F.lit(False).alias("needs_download")))
    export = jobs.StateTable(t.spark, f"{base}/export", buckets=buckets)
    export.create(t.spark.createDataFrame([], "custkey string, at bigint, last string, part bigint"))
    keyed = lambda b: b.select(path.alias("slide_path"), F.col("o_orderkey").cast("string").alias("slide_id"), "kind", "lost")
    arrive, lost = jobs.intake_to_state(state, F.current_timestamp()), jobs.requeue_lost(state)
    newest = jobs.export_merge(export, ["custkey"], "at")
    # Hooks run by phase, whatever the order they were given in.
    hooks = jobs.Hooks(("intake", "retry", "lost", "export"))
    hooks.add("export", lambda batch, batch_id, limit: newest(batch.select(
        F.col("o_custkey").cast("string").alias("custkey"), F.col("o_orderkey").cast("bigint").alias("at"),
        F.col("o_orderkey").cast("string").alias("last"), F.col("part").cast("bigint").alias("part")), batch_id))
    hooks.add("lost", lambda batch, batch_id, limit: lost(keyed(batch).where("lost AND kind = 'O'"), batch_id))
    hooks.add("retry", lambda batch, batch_id, limit: jobs.retry_sweep(state, limit)(batch, batch_id))
    hooks.add("intake", lambda batch, batch_id, limit: arrive(keyed(batch).where("kind = 'P'").select("slide_path", "slide_id"), batch_id))
    steps = jobs.in_order(hooks.steps(limit=3), f"{base}/done")
    for part in range(3):
        # What arrives between two runs is one micro-batch, of as many files as tasks wrote.
        orders.where(F.col("part") == part).write.parquet(f"{base}/in/n={part}")
        stream = t.spark.readStream.schema(orders.schema).parquet(f"{base}/in/*")
        (stream.writeStream.option("checkpointLocation", f"{base}/progress").trigger(availableNow=True)
         .foreachBatch(steps).start().awaitTermination())
    now = state.read().select(F.lit("state").alias("kind"), F.col("slide_path").alias("key"), F.col("status").alias("value"), F.col("fail_count").cast("bigint").alias("n"))
    return now.unionByName(export.read().select(F.lit("export").alias("kind"), F.col("custkey").alias("key"), F.col("last").alias("value"), F.col("part").alias("n")))
