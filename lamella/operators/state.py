"""Transitions of the slide and batch state tables: (state, input) to state.

Slide rows are keyed by ``slide_path``, batch rows by ``batch_id``. Every
function returns the whole next state; the caller writes it as a new version.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import predicates, text
from lamella.operators.ordered import first_per_key

MISSING_SHARDS = "Permanently failed: missing from shards after max retries"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _update(state: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """SQL-style conditional update; all values see the row as it was."""
    hit = F.coalesce(condition, F.lit(False))
    return state.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
                          for c in state.columns])


def _flagged(state: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """State with ``_hit`` telling whether the row's key is listed."""
    return state.join(keys.select(on).distinct().withColumn("_hit", F.lit(True)), on, "left")


def insert_new(state: DataFrame, arrivals: DataFrame, now: Column) -> DataFrame:
    """Add arrivals whose path is unknown as PENDING rows; one row per path."""
    once = first_per_key(arrivals, ["slide_path"], [F.col("slide_id")])
    fresh = once.join(state.select("slide_path"), "slide_path", "left_anti")
    defaults = {"status": F.lit("PENDING"), "fail_count": F.lit(0), "first_seen_at": now,
                "oncotree_code": F.lit(""), "needs_download": F.lit(False)}
    types = {f.name: f.dataType for f in state.schema.fields}
    own = {c: F.col(c) for c in fresh.columns if c not in ("status", "fail_count", "first_seen_at")}
    rows = fresh.select(*[
        F.coalesce(own[c], defaults[c]).cast(types[c]).alias(c) if c in own and c in defaults
        else own.get(c, defaults.get(c, F.lit(None))).cast(types[c]).alias(c) for c in state.columns])
    return state.unionByName(rows)


def claim(state: DataFrame, assignments: DataFrame, now: Column) -> DataFrame:
    """PENDING rows listed in ``assignments`` (slide_path, batch_id) become DISPATCHED; others stay."""
    wanted = assignments.groupBy("slide_path").agg(F.min("batch_id").alias("_batch"))
    joined = state.join(wanted, "slide_path", "left")
    hit = F.col("_batch").isNotNull() & (F.col("status") == "PENDING")
    return _update(joined, hit, {"status": F.lit("DISPATCHED"), "batch_id": F.col("_batch"),
                                 "dispatched_at": now}).select(*state.columns)


def claimed_counts(state: DataFrame) -> DataFrame:
    return state.where(F.col("status") == "DISPATCHED").groupBy("batch_id").agg(F.count("*").alias("n_claimed"))


def complete_batches(state: DataFrame, results: DataFrame, now: Column, quick_failure_s: float = 60) -> DataFrame:
    """Apply batch results (batch_id, exit_code, duration_s).

    Success completes the batch's dispatched rows. A failure fails them and adds
    one to every failed row of the batch. A failure within ``quick_failure_s``
    says nothing about the slides: they return to PENDING free of charge.
    """
    # Several results of one batch: the worst exit code counts, with its shortest duration. Rows without a batch stay out of
    # the join, where they would meet under one key.
    once = results.groupBy("batch_id").agg(F.max(F.struct("exit_code", (-F.col("duration_s")).alias("quick"))).alias("_r"))
    once = once.select("batch_id", F.col("_r.exit_code").alias("exit_code"), (-F.col("_r.quick")).alias("duration_s"))
    joined = state.where(F.col("batch_id").isNotNull()).join(once, "batch_id", "left")
    flying = F.col("status") == "DISPATCHED"
    ok = F.col("exit_code") == 0
    quick = (F.col("exit_code") != 0) & (F.col("duration_s") < quick_failure_s)
    slow = (F.col("exit_code") != 0) & (F.col("duration_s") >= quick_failure_s)
    charged = slow & (flying | (F.col("status") == "FAILED"))
    columns = {
        "status": F.when(flying & ok, "SUCCEEDED").when(flying & slow, "FAILED")
                   .when(flying & quick, "PENDING").otherwise(F.col("status")),
        "batch_id": F.when(flying & quick, _null("string")).otherwise(F.col("batch_id")),
        "completed_at": F.when(flying & (ok | slow), now).otherwise(F.col("completed_at")),
        "fail_count": F.when(charged, F.col("fail_count") + 1).otherwise(F.col("fail_count")),
    }
    done = joined.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in state.columns])
    return done.unionByName(state.where(F.col("batch_id").isNull()))


def complete_slides(state: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Apply per-slide results (slide_path, batch_id, ok); no retry is charged."""
    once = results.groupBy("slide_path", "batch_id").agg(F.bool_and("ok").alias("_ok"))
    joined = state.join(once, ["slide_path", "batch_id"], "left")
    return _update(joined, F.col("_ok").isNotNull(), {
        "status": F.when(F.col("_ok"), "SUCCEEDED").otherwise("FAILED"), "completed_at": now}).select(*state.columns)


def retryable(max_retries: int = 0) -> Column:
    """FAILED rows within the retry budget."""
    return (F.col("status") == "FAILED") & predicates.within_retry_budget(F.col("fail_count"), max_retries)


def retry_failed(state: DataFrame, max_retries: int = 0) -> DataFrame:
    """FAILED rows within the retry budget become PENDING again."""
    return _update(state, retryable(max_retries), {"status": F.lit("PENDING"), "batch_id": _null("string"),
                                "dispatched_at": _null("timestamp"), "error_msg": _null("string")})


def requeue_lost(state: DataFrame, lost: DataFrame) -> DataFrame:
    """SUCCEEDED rows whose outputs are gone (slide_path) become PENDING with no failures."""
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.col("status") == "SUCCEEDED")
    return _update(_flagged(state, lost, "slide_path"), hit, {
        "status": F.lit("PENDING"), "batch_id": _null("string"), "fail_count": F.lit(0)}).select(*state.columns)


def blacklist(state: DataFrame, listed: DataFrame, now: Column, max_retries: int = 999) -> DataFrame:
    """Retire slides (slide_id, reason) for good; an unknown id gets a tombstone row of its own."""
    reasons = listed.groupBy("slide_id").agg(F.max("reason").alias("_reason"))
    joined = state.join(reasons, "slide_id", "full_outer")
    known, hit = F.col("slide_path").isNotNull(), F.col("_reason").isNotNull()
    limit = F.lit(max_retries)
    columns = {
        "slide_path": F.when(known, F.col("slide_path")).otherwise(F.concat(F.lit("tombstone://"), F.col("slide_id"))),
        "status": F.when(hit, "FAILED").otherwise(F.col("status")),
        "fail_count": F.when(hit, limit).otherwise(F.col("fail_count")),
        "error_msg": F.when(hit, F.col("_reason")).otherwise(F.col("error_msg")),
        "completed_at": F.when(hit & known, now).otherwise(F.col("completed_at")),
        "batch_id": F.when(~hit, F.col("batch_id")),
        "first_seen_at": F.when(known, F.col("first_seen_at")).otherwise(now),
    }
    if "oncotree_code" in state.columns:
        columns["oncotree_code"] = F.when(known, F.col("oncotree_code")).otherwise("")
    if "needs_download" in state.columns:
        columns["needs_download"] = F.when(known, F.col("needs_download")).otherwise(False)
    return joined.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in state.columns])


def uncovered(batch: DataFrame, manifest: DataFrame, models: list[str]) -> DataFrame:
    """Distinct slides of the batch without a manifest entry for every required model.

    The manifest is reduced to the number of required models per slide first, so
    the batch is never multiplied by the models.
    """
    covered = (manifest.where(F.col("model").isin(*models)).groupBy("slide_id")
               .agg(F.count_distinct("model").alias("_n")).where(F.col("_n") == len(set(models))))
    return batch.select("slide_id").distinct().join(covered, "slide_id", "left_anti")


def apply_coverage(state: DataFrame, missing: DataFrame, max_retries: int = 0) -> DataFrame:
    """SUCCEEDED rows of uncovered slides go back to PENDING, or FAILED when out of retries; each is charged."""
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.col("status") == "SUCCEEDED")
    spent = (F.col("fail_count") + 1 >= max_retries) if max_retries > 0 else F.lit(False)
    return _update(_flagged(state, missing, "slide_id"), hit, {
        "status": F.when(spent, "FAILED").otherwise("PENDING"), "fail_count": F.col("fail_count") + 1,
        "batch_id": _null("string"), "dispatched_at": _null("timestamp"),
        "error_msg": F.when(spent, MISSING_SHARDS).otherwise(F.col("error_msg"))}).select(*state.columns)


def drop_stale_remote(state: DataFrame, replaced: DataFrame, scheme: str = "s3") -> DataFrame:
    """Remove PENDING or FAILED object-store rows of slides that are now queued for download."""
    stale = F.col("slide_path").startswith(f"{scheme}://") & F.col("status").isin("PENDING", "FAILED")
    return _flagged(state, replaced, "slide_id").where(
        ~(F.coalesce(F.col("_hit"), F.lit(False)) & stale)).select(*state.columns)


def recover_batches(batches: DataFrame, now: Column, max_resumed: int) -> DataFrame:
    """Decide the fate of RUNNING batches: adds ``recovery`` = reset, resume or NULL.

    Reset: created more than a day ago, no process, process not ``alive``, or the
    work files gone (``resumable`` false). Of the rest the first ``max_resumed``
    by id resume, the others are reset too.
    """
    running = F.col("status") == "RUNNING"
    alive = F.coalesce(F.col("alive"), F.lit(False)) & F.col("pid").isNotNull()
    keep = running & alive & F.coalesce(F.col("resumable"), F.lit(False)) & ~text.is_stale_batch(F.col("batch_id"), now)
    first = (batches.where(keep).select("batch_id").orderBy("batch_id").limit(max_resumed)
             .withColumn("_resume", F.lit(True)))
    joined = batches.join(first, "batch_id", "left")
    return joined.withColumn("recovery", F.when(running & F.coalesce(F.col("_resume"), F.lit(False)), "resume")
                             .when(running, "reset")).drop("_resume")


def apply_recovery(state: DataFrame, recovered: DataFrame) -> DataFrame:
    """Dispatched slides of batches that were reset become PENDING. Rows without a batch stay out of the join."""
    reset = recovered.where(F.col("recovery") == "reset")
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.col("status") == "DISPATCHED")
    done = _update(_flagged(state.where(F.col("batch_id").isNotNull()), reset, "batch_id"), hit, {
        "status": F.lit("PENDING"), "batch_id": _null("string")}).select(*state.columns)
    return done.unionByName(state.where(F.col("batch_id").isNull()))


def close_reset_batches(recovered: DataFrame, now: Column) -> DataFrame:
    return _update(recovered, F.col("recovery") == "reset", {
        "status": F.lit("FAILED"), "completed_at": now, "exit_code": F.lit(-1)}).drop("recovery")


def upsert(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Insert or replace whole rows by key; columns the new rows lack become NULL. Of new rows with one key the largest counts."""
    rest = [c for c in rows.columns if c != key]
    rows = rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*") if rest else rows.distinct()
    kept = table.join(rows.select(key), key, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True).select(*table.columns)


def restart_batches(batches: DataFrame, ids: DataFrame) -> DataFrame:
    return _update(_flagged(batches, ids, "batch_id"), F.col("_hit"), {
        "status": F.lit("RUNNING"), "completed_at": _null("timestamp")}).select(*batches.columns)


def cancel_batches(batches: DataFrame, ids: DataFrame) -> DataFrame:
    return batches.join(ids.select("batch_id").distinct(), "batch_id", "left_anti")


def finish_batches(batches: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Set status and exit code from (batch_id, exit_code)."""
    joined = batches.join(results.groupBy("batch_id").agg(F.max("exit_code").alias("_exit")), "batch_id", "left")
    return _update(joined, F.col("_exit").isNotNull(), {
        "status": F.when(F.col("_exit") == 0, "SUCCEEDED").otherwise("FAILED"),
        "completed_at": now, "exit_code": F.col("_exit")}).select(*batches.columns)


def set_attributes(table: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Overwrite the columns that ``values`` brings, for its keys only. Of several values of one key the largest row counts."""
    changed = [c for c in values.columns if c != key]
    once = values.groupBy(key).agg(F.max(F.struct(*changed)).alias("_v")).select(key, "_v.*")
    new = once.select(key, *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_hit"))
    return _update(table.join(new, key, "left"), F.col("_hit"),
                   {c: F.col(f"_new_{c}") for c in changed}).select(*table.columns)


def migrate(table: DataFrame, renamed: Mapping[str, str], added: Mapping[str, Column]) -> DataFrame:
    """Bring an older table up to date: rename columns, then add those still absent."""
    for old, new in renamed.items():
        if old in table.columns and new not in table.columns:
            table = table.withColumnRenamed(old, new)
    return table.withColumns({c: v for c, v in added.items() if c not in table.columns})


def backfill_progress(batches: DataFrame, progress: DataFrame) -> DataFrame:
    """Add progress rows for batches with task counts that have none yet.

    ``batches``: batch_id, tasks_done, tasks_total, tasks_failed; ``progress``:
    batch_id, succeeded, failed, pending.
    """
    done, total, failed = (F.coalesce(F.col(f"tasks_{c}"), F.lit(0)) for c in ("done", "total", "failed"))
    missing = batches.where(F.col("tasks_total").isNotNull()).join(progress.select("batch_id"), "batch_id", "left_anti")
    rows = missing.select("batch_id", done.alias("succeeded"), failed.alias("failed"),
                          F.greatest(F.lit(0), total - done - failed).alias("pending"))
    return progress.unionByName(rows)


# Listings -------------------------------------------------------------------

def pending_slides(state: DataFrame) -> DataFrame:
    """Rows to dispatch, with file id and name taken from the path where an old row lacks them."""
    rows = state.where((F.col("status") == "PENDING") & (F.col("slide_path") != ""))
    file_id, file_name = text.fill_from_uri(F.col("slide_path"), F.col("file_id"), F.col("file_name"))
    needs = F.coalesce(F.col("needs_download"), F.lit(False))
    return rows.select("slide_path", "slide_id", "oncotree_code", "download_path",
                       F.when(needs, file_id).otherwise(F.col("file_id")).alias("file_id"),
                       F.when(needs, file_name).otherwise(F.col("file_name")).alias("file_name"), "needs_download")


def requeueable(state: DataFrame, in_flight: DataFrame) -> DataFrame:
    """Pending rows that are neither queued nor being submitted."""
    return pending_slides(state).join(in_flight.select("slide_id").distinct(), "slide_id", "left_anti")


def running_batches(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("status") == "RUNNING")


def finished_with_work_dir(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("status").isin("SUCCEEDED", "FAILED") & F.col("work_dir").isNotNull()).select(
        "batch_id", "work_dir", "status")


def old_batch_logs(batches: DataFrame, now: Column, days: int) -> DataFrame:
    return batches.where(predicates.finished_before(F.col("status"), F.col("completed_at"), now, days)
                         & F.col("log_path").isNotNull()).select("batch_id", "log_path")


def manifest_paths(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("manifest_path").isNotNull()).select("manifest_path")


def all_slides(state: DataFrame) -> DataFrame:
    return state.select("slide_path", "slide_id", "oncotree_code", "status", "error_msg",
                        "first_seen_at", "completed_at")


def by_path(state: DataFrame, slide_path: str) -> DataFrame:
    return state.where(F.col("slide_path") == slide_path)


def by_slide(state: DataFrame, slide_id: str) -> DataFrame:
    return state.where(F.col("slide_id") == slide_id)


def by_batch(batches: DataFrame, batch_id: str) -> DataFrame:
    return batches.where(F.col("batch_id") == batch_id)


def download_paths(state: DataFrame, batch_id: str) -> DataFrame:
    return by_batch(state, batch_id).where(F.col("download_path").isNotNull()).select("download_path")
