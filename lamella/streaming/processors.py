"""Custom keyed state: readiness, batch triggers, watchdog, group completion.

Every processor has a batch twin in ``operators`` that gives the same rows on
the same input (see tests). Keys should be many: a queue that would be one key is
split over ``queues`` by hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lamella.streaming import use_state_store


def _run(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: str,
         time_mode: str = "None") -> DataFrame:
    use_state_store(stream.sparkSession)
    return stream.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", time_mode)


def _seconds(at: pd.Series) -> pd.Series:
    return (at - pd.Timestamp(0)) / pd.Timedelta(seconds=1)


def _expire_after(handle: StatefulProcessorHandle, keep_s: float | None, at_s: float) -> None:
    """One timer per key: ``keep_s`` after the newest row, at least a moment ahead of the watermark."""
    if keep_s is not None:
        due = int((at_s + keep_s) * 1000)
        standing = list(handle.listTimers())
        if not standing or max(standing) < due:
            for expiry in standing:
                handle.deleteTimer(expiry)
            handle.registerTimer(due)


# Readiness ------------------------------------------------------------------

class Readiness(StatefulProcessor):
    """Emits a file once it has been seen unchanged for long enough.

    With ``keep_s`` a file's state goes by event time when it was last looked at so long before the
    watermark: also that of files that were emitted, so that the state holds the files of that span only.
    """

    def __init__(self, wait_s: float, keep_s: float | None = None) -> None:
        self.wait_s, self.keep_s = wait_s, keep_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "length long, modified double, since double, emitted boolean")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter([])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = pd.concat(list(rows)).sort_values("observed_at", kind="stable")
        state = self.last.get() if self.last.exists() else None
        times, modified = _seconds(seen["observed_at"]), _seconds(seen["modified"])
        out = None
        for length, changed, at, observed in zip(seen["length"], modified, times, seen["observed_at"]):
            if state is not None and state[3]:
                break
            if state is None or state[0] != length or state[1] != changed:
                state = (int(length), float(changed), float(at), False)
            elif at - state[2] >= self.wait_s:
                state = (*state[:3], True)
                out = (key[0], int(length), observed)
        self.last.update(tuple(state))
        _expire_after(self.handle, self.keep_s, times.max())
        if out is not None:
            yield pd.DataFrame([out], columns=["path", "length", "ready_at"])

    def close(self) -> None:
        pass


def ready_files(observations: DataFrame, wait_s: float, keep_s: float | None = None, late: str = "0 seconds") -> DataFrame:
    """(path, length, ready_at) from repeated listings (path, length, modified, observed_at); see ``Readiness`` for ``keep_s``."""
    plain = observations.select("path", "length", *[F.col(c).cast("timestamp") for c in ("modified", "observed_at")])
    if keep_s is not None:
        plain = plain.withWatermark("observed_at", late)
    return _run(plain, ["path"], Readiness(wait_s, keep_s), "path string, length bigint, ready_at timestamp", "None" if keep_s is None else "EventTime")


# Batch trigger --------------------------------------------------------------

def next_size(sizes: Sequence[int], batch_no: int) -> int:
    return sizes[batch_no % len(sizes)]


def fires(n: int, waited_s: float, size: int, max_wait_s: float, min_size: int) -> bool:
    """Enough rows, or the first has waited long enough; never below the minimum size."""
    return n > 0 and n >= min_size and (n >= size or waited_s >= max_wait_s)


#: So many rows are Python objects at a time.
WALK_ROWS = 50_000


def _in_order(rows: Iterator[pd.DataFrame]) -> Iterator[tuple[float, str]]:
    """(seconds, slide_id) by arrival. All rows of a key are held as plain columns; only ``WALK_ROWS`` at a time become objects."""
    times, slides = [], []
    for part in rows:
        times.append(_seconds(part["arrived_at"]).to_numpy())
        slides.append(pa.array(part["slide_id"], pa.large_string(), from_pandas=True))
    at, slide = np.concatenate(times), pa.concat_arrays(slides)
    del times, slides
    order = pc.sort_indices(pa.table({"at": at, "slide": slide}), sort_keys=[("at", "ascending"), ("slide", "ascending")])
    for start in range(0, len(order), WALK_ROWS):
        here = order.slice(start, WALK_ROWS)
        yield from zip(at[here.to_numpy()].tolist(), slide.take(here).to_pylist())


class BatchTrigger(StatefulProcessor):
    """Cuts a queue into batches by size or waiting time, with rotating sizes.

    The first arrival is kept when rows are left over after a batch, so these may
    fire the time trigger at once. Times are arrival times; with processing-time
    timers a quiet queue also fires without a new arrival.
    """

    def __init__(self, sizes: Sequence[int], max_wait_s: float, min_size: int = 1, timers: bool = False) -> None:
        self.sizes, self.max_wait_s, self.min_size, self.timers = list(sizes), max_wait_s, min_size, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getListState("queue", "slide_id string, at double")
        self.head = handle.getValueState("head", "batch_no long, first_at double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pending = [tuple(r) for r in self.queue.get()] if self.queue.exists() else []
        batch_no, first_at = self._head()
        out: list = []
        for at, same in groupby(_in_order(rows), itemgetter(0)):
            batch_no, first_at = self._drain(key, pending, batch_no, first_at, at, out, by_time=True)
            if not pending:
                first_at = at
            pending += [(s, at) for _, s in same]
            batch_no, first_at = self._drain(key, pending, batch_no, first_at, at, out, by_time=False)
            if len(out) >= WALK_ROWS:
                yield pd.DataFrame(out, columns=["queue", "batch_no", "slide_id"])
                out = []
        self._keep(pending, batch_no, first_at, timerValues)
        if out:
            yield pd.DataFrame(out, columns=["queue", "batch_no", "slide_id"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        pending = [tuple(r) for r in self.queue.get()] if self.queue.exists() else []
        batch_no, first_at = self._head()
        out: list = []
        now = timerValues.getCurrentProcessingTimeInMs() / 1000
        batch_no, first_at = self._drain(key, pending, batch_no, first_at, now, out, by_time=True)
        self._keep(pending, batch_no, first_at, timerValues)
        if out:
            yield pd.DataFrame(out, columns=["queue", "batch_no", "slide_id"])

    def _head(self) -> tuple[int, float]:
        if not self.head.exists():
            return 0, 0.0
        batch_no, first_at = self.head.get()
        return int(batch_no), float(first_at)

    def _drain(self, key, pending, batch_no, first_at, now, out, by_time):
        wait = self.max_wait_s if by_time else float("inf")
        while fires(len(pending), now - first_at, size := next_size(self.sizes, batch_no), wait, self.min_size):
            out += [(key[0], batch_no, s) for s, _ in pending[:size]]
            del pending[:size]
            batch_no += 1
        return batch_no, first_at

    def _keep(self, pending, batch_no, first_at, timerValues) -> None:
        self.head.update((batch_no, float(first_at)))
        if pending:
            self.queue.put(pending)
        else:
            self.queue.clear()
        if self.timers:
            for expiry in list(self.handle.listTimers()):
                self.handle.deleteTimer(expiry)
            if pending:
                due = int((first_at + self.max_wait_s) * 1000)
                self.handle.registerTimer(max(due, timerValues.getCurrentProcessingTimeInMs() + 1))

    def close(self) -> None:
        pass


def batches(arrivals: DataFrame, sizes: Sequence[int], max_wait_s: float, min_size: int = 1, by: str | None = None,
            timers: bool = False) -> DataFrame:
    """(queue, batch_no, slide_id) from arrivals (slide_id, arrived_at and the column ``by`` that names the queue).

    Every queue is one state key, so ``by`` decides how far the work spreads. Without it there is one queue.
    ``open_batches`` flushes what is still waiting.
    """
    queue = F.col(by).cast("string") if by else F.lit("all")
    rows = arrivals.select(queue.alias("queue"), F.col("slide_id").cast("string").alias("slide_id"),
                           F.col("arrived_at").cast("timestamp").alias("arrived_at"))
    return _run(rows, ["queue"], BatchTrigger(sizes, max_wait_s, min_size, timers),
                "queue string, batch_no bigint, slide_id string", "ProcessingTime" if timers else "None")


def open_batches(arrivals: DataFrame, emitted: DataFrame, by: str | None = None) -> DataFrame:
    """(queue, batch_no, slide_id) of the arrivals no batch has taken yet: each queue's flush, one more batch."""
    queue = F.col(by).cast("string") if by else F.lit("all")
    waiting = arrivals.select(queue.alias("queue"), F.col("slide_id").cast("string").alias("slide_id")).join(
        emitted, ["queue", "slide_id"], "left_anti")
    last = emitted.groupBy("queue").agg(F.max("batch_no").alias("last"))
    return waiting.join(last, "queue", "left").select("queue", (F.coalesce("last", F.lit(-1)) + 1).alias("batch_no"), "slide_id")


# Watchdog -------------------------------------------------------------------

class Watchdog(StatefulProcessor):
    """Emits a batch whose heartbeat has been silent for longer than the limit; a heartbeat resets it."""

    def __init__(self, limit_s: float) -> None:
        self.limit_ms = int(limit_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at_ms long, finished boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        beats = pd.concat(list(rows))
        at_ms = int(_seconds(beats["at"]).max() * 1000)
        finished = bool(beats["finished"].any())
        if self.last.exists():
            before, was_finished = self.last.get()
            at_ms, finished = max(at_ms, int(before)), finished or bool(was_finished)
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)
        self.last.update((at_ms, finished))
        if not finished:
            self.handle.registerTimer(at_ms + self.limit_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at_ms, _ = self.last.get()
        yield pd.DataFrame({"batch_id": [str(key[0])], "last_at": [pd.Timestamp(int(at_ms), unit="ms")]})

    def close(self) -> None:
        pass


def stuck_batches(heartbeats: DataFrame, limit_s: float, late: str) -> DataFrame:
    """(batch_id, last_at) of silent batches from heartbeats (batch_id, at, finished), in event time."""
    beats = heartbeats.select(F.col("batch_id").cast("string").alias("batch_id"), F.col("at").cast("timestamp").alias("at"),
                              "finished").withWatermark("at", late)
    return _run(beats, ["batch_id"], Watchdog(limit_s), "batch_id string, last_at timestamp", "EventTime")


# Group completion -----------------------------------------------------------

#: New ids of a sample that a task holds before they go into the state.
FRESH = 10_000


class GroupCompletion(StatefulProcessor):
    """Emits a sample as soon as its expected number of slides has arrived.

    The state is a set of ids that grows entry by entry and a count; nothing is
    rewritten per micro-batch, and the ids go when the sample is complete. Ids of a micro-batch that completes
    its sample are not written at all, up to ``FRESH`` of them. With ``keep_s`` all of a sample's
    state goes when its last row lies so long before the watermark, complete or not.
    """

    def __init__(self, keep_s: float | None = None) -> None:
        self.keep_s = keep_s

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        self.count.clear()
        return iter([])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "slide_id string", "present boolean")
        self.count = handle.getValueState("count", "n int, emitted boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = self.count.exists()
        n, emitted = self.count.get() if stored else (0, False)
        expected, newest = 0, 0.0
        fresh: set[str] = set()

        def store() -> None:
            for slide in fresh:
                self.seen.updateValue((slide,), (True,))
            fresh.clear()

        for part in rows:
            if self.keep_s is not None:
                newest = max(newest, float(_seconds(part["at"]).max()))
            if emitted:
                continue
            expected = max(expected, int(part["n_slides"].max()))
            for slide in part["slide_id"].astype(str).unique():
                if slide not in fresh and not (stored and self.seen.containsKey((slide,))):
                    fresh.add(slide)
                    n += 1
                    if len(fresh) >= FRESH:
                        store()
                        stored = True
        _expire_after(self.handle, self.keep_s, newest)
        if emitted:
            return
        complete = n >= expected
        self.count.update((n, complete))
        if not complete:
            store()
        elif stored:
            self.seen.clear()
        if complete:
            yield pd.DataFrame({"sample_id": [str(key[0])], "n_slides": [n]})

    def close(self) -> None:
        pass


def completed_samples(rows: DataFrame, at: str | None = None, keep_s: float | None = None, late: str = "0 seconds") -> DataFrame:
    """(sample_id, n_slides) of complete samples from (sample_id, slide_id, n_slides).

    With ``at`` (event time) and ``keep_s`` a sample is forgotten that long after its last row.
    """
    plain = rows.select(F.col("sample_id").cast("string").alias("sample_id"),
                        F.col("slide_id").cast("string").alias("slide_id"), F.col("n_slides").cast("int").alias("n_slides"),
                        *([F.col(at).cast("timestamp").alias("at")] if keep_s is not None else []))
    if keep_s is not None:
        plain = plain.withWatermark("at", late)
    return _run(plain, ["sample_id"], GroupCompletion(keep_s), "sample_id string, n_slides int", "None" if keep_s is None else "EventTime")
