"""Stream queries over the events, each run to its end and checked against its batch meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.plans.catalog import Tables, query, second
from lamella.streaming import intake, jobs, processors

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _events(t: Tables) -> DataFrame:
    stream = intake.table_stream(t.spark, t.folder, "events.parquet", EVENTS)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    rows = _events(t).select("user_id", "event_type")
    return jobs.drain(intake.known_once(rows, ["user_id", "event_type"]), "dedupe")


@query("""
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at FROM events GROUP BY 1, 2""")
def stream_throughput(t: Tables) -> DataFrame:
    counts = intake.throughput_windows(_events(t), "ts", "3650 days", "6 hours", by=["event_type"])
    table = jobs.drain_updates(counts.withColumn("window_start", F.col("window.start")), ["window_start", "event_type"], "throughput")
    return table.select(second(F.col("window_start")).alias("window_start"), "event_type", "n", second(F.col("first_at")).alias("first_at"))


@query("""
WITH RECURSIVE e AS (SELECT event_id, event_type, epoch_us(ts) AS seen, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events),
walk AS (
  SELECT r, event_type, event_id, seen AS first_at, 1 AS held, 0 AS batch_no FROM e WHERE r = 1
  UNION ALL
  SELECT e.r, e.event_type, e.event_id, CASE WHEN w.held >= 25 OR e.seen - w.first_at >= 7200000000 THEN e.seen ELSE w.first_at END,
         CASE WHEN w.held >= 25 OR e.seen - w.first_at >= 7200000000 THEN 1 ELSE w.held + 1 END,
         CASE WHEN w.held >= 25 OR e.seen - w.first_at >= 7200000000 THEN w.batch_no + 1 ELSE w.batch_no END
  FROM walk w JOIN e ON e.r = w.r + 1 AND e.event_type = w.event_type)
SELECT event_type, event_id, CAST(batch_no AS BIGINT) AS batch_no FROM walk""")
def stream_batches(t: Tables) -> DataFrame:
    """Batches of each event type by size or waiting time; the batches still open at the end are flushed."""
    def arrivals(events: DataFrame) -> DataFrame:
        return events.select("event_type", F.format_string("%012d", "event_id").alias("slide_id"), F.col("ts").alias("arrived_at"))
    out = jobs.drain(processors.batches(arrivals(_events(t)), [25], 7200, by="event_type"), "batches")
    whole = out.unionByName(processors.open_batches(arrivals(t.events), out, "event_type"))
    return whole.select(F.col("queue").alias("event_type"), F.col("slide_id").cast("bigint").alias("event_id"), "batch_no")


@query("""
WITH n AS (SELECT user_id, count(DISTINCT event_id) AS n FROM events GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS sample_id FROM n WHERE n >= 60""")
def stream_group_completion(t: Tables) -> DataFrame:
    """Samples announced the moment their expected number of slides has arrived."""
    rows = _events(t).select(F.col("user_id").alias("sample_id"), F.col("event_id").alias("slide_id"), F.lit(60).alias("n_slides"))
    return jobs.drain(processors.completed_samples(rows), "completion").select("sample_id")


@query("""
WITH seen AS (SELECT user_id, ts, event_id, CAST(floor(value / 40) AS BIGINT) AS length FROM events),
marked AS (SELECT *, CASE WHEN lag(length) OVER w IS DISTINCT FROM length THEN 1 ELSE 0 END AS changed FROM seen WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
runs AS (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM marked),
waits AS (SELECT *, min(ts) OVER (PARTITION BY user_id, run) AS since FROM runs)
SELECT CAST(user_id AS VARCHAR) AS path, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ready_at
FROM waits WHERE ts > since AND epoch(ts) - epoch(since) >= 21600 GROUP BY 1""")
def stream_readiness(t: Tables) -> DataFrame:
    """Files seen with the same size for six hours; every event is one look at one file."""
    looks = _events(t).select(F.col("user_id").cast("string").alias("path"), F.floor(F.col("value") / 40).cast("bigint").alias("length"),
                              F.lit("2024-01-01").cast("timestamp").alias("modified"), F.col("ts").alias("observed_at"))
    ready = jobs.drain(processors.ready_files(looks, 21600), "ready")
    return ready.select("path", second(F.col("ready_at")).alias("ready_at"))


@query("""
WITH last AS (SELECT CAST(user_id AS VARCHAR) AS batch_id, max(ts) AS last_at FROM events GROUP BY 1),
mark AS (SELECT max(ts) - INTERVAL 1 MINUTE AS w FROM events)
SELECT batch_id, strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_at FROM last, mark WHERE last_at + INTERVAL 12 HOUR <= w""")
def stream_watchdog(t: Tables) -> DataFrame:
    """Batches without a heartbeat for twelve hours of event time."""
    beats = _events(t).select(F.col("user_id").alias("batch_id"), F.col("ts").alias("at"), F.lit(False).alias("finished"))
    return jobs.drain(processors.stuck_batches(beats, 12 * 3600, "1 minute"), "watchdog").select("batch_id", second(F.col("last_at")).alias("last_at"))
