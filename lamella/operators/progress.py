"""Progress figures of slides, batches and scheduler jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import numeric, predicates, text


def count_by_status(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def job_history_summary(history: DataFrame) -> DataFrame:
    """Counts by final state and elapsed time of completed jobs, as one row.

    ``history``: state, exit_code, elapsed and optionally stderr.
    """
    state, seconds = F.trim("state"), text.elapsed_seconds(F.col("elapsed"))
    done = state == "COMPLETED"
    taken = F.when(done, seconds)
    return history.agg(
        F.count_if(done).alias("n_completed"), F.count_if(state.startswith("FAILED")).alias("n_failed"),
        F.count_if(state.startswith("CANCEL")).alias("n_cancelled"), F.count_if(state == "TIMEOUT").alias("n_timeout"),
        F.floor(F.avg(taken)).cast("bigint").alias("avg_elapsed_s"),
        F.min(taken).alias("min_elapsed_s"), F.max(taken).alias("max_elapsed_s"))


def failure_types(history: DataFrame) -> DataFrame:
    """Failed, cancelled and timed-out jobs by cause."""
    state = F.trim("state")
    stderr = F.col("stderr") if "stderr" in history.columns else F.lit("")
    failed = state.startswith("FAILED") | state.startswith("CANCEL") | (state == "TIMEOUT")
    cause = text.failure_class(stderr, F.col("exit_code"), state)
    return history.where(failed).groupBy(cause.alias("failure_type")).agg(F.count("*").alias("n"))


def job_rollup(jobs: DataFrame) -> DataFrame:
    """Current jobs per batch and process: running, pending, distinct nodes, longest run, stalled."""
    seconds = text.elapsed_seconds(F.col("elapsed"))
    running = F.col("state") == "RUNNING"
    node = F.when(running & (F.col("node") != "") & (F.col("node") != "N/A"), F.col("node"))
    return (jobs.withColumns({"batch_id": text.batch_id_of_workdir(F.col("workdir")),
                              "process": text.process_short_name(F.col("name"))})
            .groupBy("batch_id", "process")
            .agg(F.count_if(running).alias("n_running"), F.count_if(F.col("state") == "PENDING").alias("n_pending"),
                 F.count_distinct(node).alias("n_nodes"), F.max(F.when(running, seconds)).alias("max_elapsed_s"),
                 F.count_if(predicates.stalled(F.col("state"), seconds)).alias("n_stalled")))


def pending_reasons(jobs: DataFrame) -> DataFrame:
    reason = F.regexp_replace("reason", r"^[()]+|[()]+$", "")
    return jobs.where(F.col("state") == "PENDING").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def stalled_jobs(jobs: DataFrame, limit_s: int = 7200) -> DataFrame:
    seconds = text.elapsed_seconds(F.col("elapsed"))
    return jobs.where(predicates.stalled(F.col("state"), seconds, limit_s)).select(
        "job_id", text.process_short_name(F.col("name")).alias("process"), "node", seconds.alias("elapsed_s"),
        text.batch_id_of_workdir(F.col("workdir")).alias("batch_id"))


def trace_rollup(trace: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Task counts of a trace."""
    return trace.groupBy(*by).agg(
        F.count_if(F.col("status") == "COMPLETED").alias("n_completed"),
        F.count_if(F.col("status") == "CACHED").alias("n_cached"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"), F.count("*").alias("n_total"))


def trace_failures(trace: DataFrame) -> DataFrame:
    """Failed tasks as rows."""
    return trace.where(F.col("status") == "FAILED").select("name", "exit", "hash")


def throughput(slides: DataFrame, now: Column, window_hours: float = 6, undispatched: Column | None = None) -> DataFrame:
    """Completion rate over the window and time left, as one row.

    The rate divides by the time since the first completion in the window, so a
    burst does not inflate it. It needs two completions and more than a minute.
    """
    now_s = now.cast("timestamp").cast("double")
    done_s = F.col("completed_at").cast("timestamp").cast("double")
    inside = (F.col("status") == "SUCCEEDED") & (done_s >= now_s - window_hours * 3600) & (done_s <= now_s)
    waiting = F.col("status").isin("PENDING", "DISPATCHED")
    totals = slides.agg(F.count_if(inside).alias("completed_in_window"), F.min(F.when(inside, done_s)).alias("_first"),
                        F.count_if(waiting).alias("_waiting"))
    elapsed = F.least(now_s - F.col("_first"), F.lit(window_hours * 3600.0))
    rate = F.when((F.col("completed_in_window") >= 2) & (elapsed > 60),
                  F.round(F.col("completed_in_window") / (elapsed / 3600), 1))
    left = F.col("_waiting") + (undispatched if undispatched is not None else F.lit(0))
    out = totals.withColumns({"throughput_per_hour": rate, "remaining": left})
    eta = F.round(F.col("remaining") / F.nullif(F.col("throughput_per_hour"), F.lit(0.0)) * 3600).cast("bigint")
    return (out.withColumn("eta_seconds", eta).withColumn("eta", text.pretty_duration(F.col("eta_seconds")))
            .select("completed_in_window", "throughput_per_hour", "remaining", "eta_seconds", "eta"))


def undispatched(inventory: DataFrame, state: DataFrame) -> DataFrame:
    """Inventory size, known slides and the difference (never below 0), as one row."""
    both = inventory.select(F.lit(1).alias("_i"), F.lit(0).alias("_s")).unionAll(
        state.select(F.lit(0).alias("_i"), F.lit(1).alias("_s")))
    totals = both.agg(F.coalesce(F.sum("_i"), F.lit(0)).alias("n_inventory"), F.coalesce(F.sum("_s"), F.lit(0)).alias("n_known"))
    return totals.withColumn("n_undispatched", F.greatest(F.lit(0), F.col("n_inventory") - F.col("n_known")))


def completion(counts: DataFrame, done: str, total: str) -> DataFrame:
    return counts.withColumn("pct_done", numeric.percentage(F.col(done), F.col(total)))


def exhausted(state: DataFrame, max_retries: int) -> DataFrame:
    return state.agg(F.count_if(F.col("fail_count") >= max_retries).alias("n_exhausted"))


def recent_batches(batches: DataFrame, n: int = 30) -> DataFrame:
    """The last batches by dispatch time, with their duration."""
    duration = F.col("completed_at").cast("timestamp").cast("double") - F.col("dispatched_at").cast("timestamp").cast("double")
    return (batches.withColumn("duration_s", F.floor(duration).cast("bigint"))
            .orderBy(F.col("dispatched_at").desc_nulls_last(), "batch_id").limit(n))


def batches_with_jobs(batches: DataFrame, jobs: DataFrame) -> DataFrame:
    """Batches with the totals of their scheduler jobs, where they have any."""
    per_batch = job_rollup(jobs).groupBy("batch_id").agg(
        F.sum("n_running").alias("jobs_running"), F.sum("n_pending").alias("jobs_pending"),
        F.max("max_elapsed_s").alias("jobs_max_elapsed_s"))
    return batches.join(per_batch.where(F.col("batch_id").isNotNull()), "batch_id", "left")


def runs_with_batches(runs: DataFrame, batches: DataFrame) -> DataFrame:
    """Run names matched to batch ids by their eight-digit suffix or whole id."""
    suffix = text.run_suffix(F.col("run_name"))
    short = batches.select("batch_id", F.substring_index("batch_id", "_", -1).alias("_suffix"))
    whole = batches.select("batch_id", F.col("batch_id").alias("_suffix"))
    index = short.unionByName(whole).groupBy("_suffix").agg(F.min("batch_id").alias("batch_id"))
    joined = runs.withColumn("_suffix", suffix).join(index, "_suffix", "left")
    return joined.withColumn("batch_id", F.coalesce("batch_id", "_suffix")).drop("_suffix")


def shard_counts(listing: DataFrame) -> DataFrame:
    """Objects and tar shards per model of a listing (model, path)."""
    return listing.groupBy("model").agg(F.count("*").alias("n_objects"),
                                        F.count_if(F.col("path").endswith(".tar")).alias("n_shards"))


def configured_and_seen(configured: Sequence[str], seen: DataFrame, column: str = "model") -> DataFrame:
    """Union of configured names and names found in the data."""
    names = seen.select(column)
    listed = names.sparkSession.createDataFrame([(c,) for c in configured], f"{column} string")
    return listed.unionByName(names).distinct()
