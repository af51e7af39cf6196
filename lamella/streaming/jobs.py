"""Running streams to tables, and the ordered steps after each micro-batch."""

from __future__ import annotations

import threading
import warnings
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lamella.operators import merge, state
from lamella.operators.inventory import scd_merge
from lamella.session import scratch_dir
from lamella.sinks.buckets import BucketTable
from lamella.sources.files import path_exists

Step = Callable[[DataFrame, int], None]


class LateRows(StreamingQueryListener):
    """Rows that came later than the watermark allows, summed over every micro-batch of each query."""

    def __init__(self) -> None:
        self.rows: Counter = Counter()
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.rows[str(progress.runId)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


def run_to_end(start: Callable[[], StreamingQuery], spark: SparkSession, limit_s: float | None = None, patience_s: float = 30) -> int:
    """Run a stream over what is there now; returns, and warns of, the rows that came too late."""
    late = LateRows()
    spark.streams.addListener(late)
    try:
        query = start()
        if limit_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(limit_s):
            query.stop()
            raise TimeoutError(f"stream {query.id} did not finish within {limit_s} s")
        # Events arrive in order and after the run: the last one says that all progress was seen.
        late.ended[str(query.runId)].wait(patience_s)
    finally:
        spark.streams.removeListener(late)
    number = late.rows[str(query.runId)]
    if number:
        warnings.warn(f"{number} rows came later than the watermark allows and were not counted", stacklevel=3)
    return number


def drain(stream: DataFrame, name: str, path: str | None = None, limit_s: float | None = None) -> DataFrame:
    """Run a stream over what is there now into a Parquet table, and read that table. It may take as long as it takes,
    unless the caller sets a limit."""
    spark = stream.sparkSession
    base = path or scratch_dir(spark, name)
    run_to_end(lambda: (stream.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/progress")
                        .outputMode("append").trigger(availableNow=True).start()), spark, limit_s)
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def drain_updates(stream: DataFrame, keys: Sequence[str], name: str, limit_s: float | None = None) -> DataFrame:
    """As ``drain`` for aggregates in update mode: the newest row per key.

    Each micro-batch overwrites its own folder, so a repeated batch changes nothing.
    """
    base = scratch_dir(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/rows/batch_no={batch_id}")

    run_to_end(lambda: (stream.writeStream.outputMode("update").option("checkpointLocation", f"{base}/progress")
                        .trigger(availableNow=True).foreachBatch(write).start()), stream.sparkSession, limit_s)
    rows = stream.sparkSession.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows")
    return merge.latest_per_key(rows, keys, "batch_no").drop("batch_no")


def in_order(steps: Sequence[tuple[str, Step]], done_folder: str) -> Step:
    """A ``foreachBatch`` function that runs named steps in order, each once per batch id.

    A finished step leaves a marker. When a batch is repeated after a failure,
    only the steps that had not finished run again.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for name, step in steps:
            marker = f"{done_folder.rstrip('/')}/{batch_id:012d}-{name}"
            if not path_exists(spark, marker):
                step(batch, batch_id)
                spark.range(1).write.mode("overwrite").parquet(marker)
    return run


#: Steps of one micro-batch may change one table in turn; each has its place in the order of versions.
STEPS = 10
KEEP = 2


class StateTable(BucketTable):
    """A state table in buckets of its first column; a version belongs to one step of one micro-batch.

    Each step rewrites only the buckets it changes, and files that the last
    ``KEEP`` versions do not read are deleted.
    """

    def step(self, batch_id: int, change: Callable[[DataFrame], DataFrame], touched: Callable[[DataFrame], DataFrame] | None = None,
             place: int = 0) -> list[int]:
        """The change of one micro-batch, once: a repeated one finds its version and does nothing."""
        changed = self.advance((batch_id + 1) * STEPS + place, change, touched)
        self.expire(KEEP)
        return changed


def intake_to_state(table: StateTable, now: Column) -> Step:
    """New paths of each micro-batch become PENDING rows."""
    return lambda batch, batch_id: table.step(batch_id, lambda s: state.insert_new(s, batch, now), lambda _: batch.select("slide_path"))


def retry_sweep(table: StateTable, max_retries: int) -> Step:
    """Failed rows within their budget are queued again on every trigger."""
    return lambda batch, batch_id: table.step(
        batch_id, lambda s: state.retry_failed(s, max_retries), lambda s: s.where(state.retryable(max_retries)).select("slide_path"), 1)


def requeue_lost(table: StateTable) -> Step:
    """Rows of the batch (slide_path) whose outputs are gone are queued again."""
    return lambda batch, batch_id: table.step(batch_id, lambda s: state.requeue_lost(s, batch), lambda _: batch.select("slide_path"), 2)


def snapshot_to_inventory(table: StateTable, sync_date: Column) -> Step:
    """Each micro-batch is a whole snapshot: merged into the dated inventory, also when rows reappear. Buckets without a change stay."""
    return lambda batch, batch_id: table.step(batch_id, lambda old: scd_merge(old, batch, sync_date).drop("change"))


def export_merge(table: StateTable, keys: Sequence[str], newest: str, delete_missing: bool = False, evolve: bool = True) -> Step:
    """The newest exported row per key of each micro-batch is merged into the target."""
    def step(batch: DataFrame, batch_id: int) -> None:
        rows = merge.latest_per_key(batch, keys, newest)
        table.step(batch_id, lambda target: merge.merge(target, rows, keys, delete_missing, evolve),
                   None if delete_missing else lambda _: rows.select(*keys))
    return step


class Hooks:
    """Registered callables per phase, run with a context of named values."""

    def __init__(self, phases: Sequence[str] = ("wds", "coverage", "db_sync")) -> None:
        self.phases = list(phases)
        self.registered: dict[str, list] = {p: [] for p in self.phases}

    def add(self, phase: str, hook: Callable[..., None]) -> None:
        self.registered[phase].append(hook)

    def steps(self, **context) -> list[tuple[str, Step]]:
        def bind(hook):
            return lambda batch, batch_id: hook(batch=batch, batch_id=batch_id, **context)
        return [(f"{p}-{i}", bind(h)) for p in self.phases for i, h in enumerate(self.registered[p])]


def ready_in_batch(observations: DataFrame, wait_s: float) -> DataFrame:
    """Batch twin of ``ready_files`` over a log of listings: windows per path, a handful of rows each."""
    from pyspark.sql import Window

    by_time = Window.partitionBy("path").orderBy("observed_at")
    changed = (~F.lag("length").over(by_time).eqNullSafe(F.col("length"))
               | ~F.lag("modified").over(by_time).eqNullSafe(F.col("modified")))
    runs = observations.withColumn("_run", F.sum(changed.cast("int")).over(by_time))
    since = F.first("observed_at").over(Window.partitionBy("path", "_run").orderBy("observed_at"))
    waited = F.col("observed_at").cast("double") - since.cast("double")
    settled = runs.withColumn("_waited", waited).withColumn("_first", since == F.col("observed_at"))
    return (settled.where(~F.col("_first") & (F.col("_waited") >= wait_s)).groupBy("path")
            .agg(F.min_by("length", "observed_at").alias("length"), F.min("observed_at").alias("ready_at")))
