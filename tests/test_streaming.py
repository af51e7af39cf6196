"""Streams against their batch twins and the loop they replace."""

import random

import pytest
from pyspark.sql import functions as F

from lamella.functions import predicates
from lamella.operators import batching, merge
from lamella.sinks.buckets import BucketTable
from lamella.streaming import intake, jobs, processors
from tests.conftest import rows


def feed(spark, folder, frames):
    """A stream over frames written as one file each, read one file per trigger in order."""
    schema = frames[0].schema
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/part={i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def stamped(spark, data, names):
    columns = names.split()
    df = spark.createDataFrame(data, ", ".join(c.replace(":", " ") for c in columns))
    return df.select(*[F.timestamp_seconds(c.split(":")[0]).alias(c.split(":")[0]) if c.endswith("_at:bigint") or c in ("at:bigint", "modified:bigint") else F.col(c.split(":")[0]) for c in columns])


def test_known_paths_once(spark, tmp_path):
    frames = [spark.createDataFrame([("a",), ("b",)], "slide_path string"), spark.createDataFrame([("b",), ("c",)], "slide_path string")]
    assert rows(jobs.drain(intake.known_once(feed(spark, str(tmp_path), frames)), "once")) == [("a",), ("b",), ("c",)]


def test_readiness_equals_batch(spark, tmp_path):
    looks = [("a", 10, 1, 0), ("a", 10, 1, 30), ("a", 10, 1, 60), ("a", 10, 1, 90),  # ready at 60
             ("b", 10, 1, 0), ("b", 12, 2, 60), ("b", 12, 2, 119), ("b", 12, 2, 120),  # change resets
             ("c", 5, 1, 0), ("d", 7, 1, 0), ("d", 7, 2, 60), ("d", 7, 3, 120)]
    df = stamped(spark, looks, "path:string length:bigint modified:bigint observed_at:bigint")
    frames = [df.where(F.col("observed_at").cast("long").between(lo, lo + 59)) for lo in (0, 60, 120)]
    ready = jobs.drain(processors.ready_files(feed(spark, str(tmp_path), frames), 60), "ready")
    got = rows(ready.select("path", "length", F.col("ready_at").cast("long")))
    assert got == [("a", 10, 60), ("b", 12, 120)]
    assert rows(jobs.ready_in_batch(df, 60).select("path", "length", F.col("ready_at").cast("long"))) == got


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_batch_form(spark, tmp_path, seed):
    rng, at, data = random.Random(seed), 0, []
    for i in range(120):
        at += rng.choice([1, 2, 3, 50])
        data.append((f"s{i:04d}", at))
    df = stamped(spark, data, "slide_id:string arrived_at:bigint")
    cut = [0, 40, 41, 90, 10**6]
    frames = [df.where((F.col("slide_id") >= f"s{a:04d}") & (F.col("slide_id") < f"s{b:04d}")) for a, b in zip(cut, cut[1:]) if a < 120]
    got = {r.slide_id: r.batch_no for r in jobs.drain(processors.batches(feed(spark, str(tmp_path), frames), [6], 40), "b").collect()}
    want = {r.slide_id: r.batch_no for r in batching.size_or_time_batches(df, "arrived_at", "slide_id", 6, 40).collect()}
    open_batch = max(want.values())
    assert got == {k: v for k, v in want.items() if v < open_batch or k in got}
    assert all(got[k] == want[k] for k in got)


def test_rotation_minimum_and_kept_first_arrival(spark, tmp_path):
    """Sizes rotate, the minimum holds rows back, and left-over rows keep the first arrival."""
    data = [(f"s{i}", 0) for i in range(5)] + [("s5", 100)]
    df = stamped(spark, data, "slide_id:string arrived_at:bigint")
    got = {r.slide_id: r.batch_no for r in jobs.drain(processors.batches(feed(spark, str(tmp_path / "a"), [df]), [3, 4], 100), "r").collect()}
    # Three fill batch 0. The other two waited since 0, so at 100 the time trigger takes them.
    assert got == {"s0": 0, "s1": 0, "s2": 0, "s3": 1, "s4": 1}
    held = jobs.drain(processors.batches(feed(spark, str(tmp_path / "b"), [df]), [10], 50, min_size=6), "m")
    assert held.count() == 0
    assert processors.fires(5, 1e9, 10, 50, 6) is False and processors.fires(6, 0, 6, 50, 6) is True
    assert [processors.next_size([175, 325], i) for i in range(3)] == [175, 325, 175]


def test_watchdog(spark, tmp_path):
    beats = [("quiet", 100, False), ("alive", 100, False), ("done", 100, False), ("done", 110, True), ("alive", 7000, False), ("late", 9000, False), ("alive", 14000, False), ("tick", 20000, False)]
    df = stamped(spark, beats, "batch_id:string at:bigint finished:boolean")
    frames = [df.where(F.col("at").cast("long").between(lo, hi)) for lo, hi in ((0, 5000), (5001, 10000), (10001, 15000), (15001, 30000))]
    stuck = jobs.drain(processors.stuck_batches(feed(spark, str(tmp_path), frames), 7200, "1 minute"), "w")
    assert rows(stuck, "batch_id") == [("late",), ("quiet",)]
    now = F.timestamp_seconds(F.lit(20000 - 60))
    last = df.groupBy("batch_id").agg(F.max("at").alias("at"), F.bool_or("finished").alias("f"))
    twin = last.where(~F.col("f") & predicates.stuck(F.lit("RUNNING"), F.lit(1), F.col("at"), now, 2))
    assert rows(twin, "batch_id") == [("late",), ("quiet",)]


def test_group_completion(spark, tmp_path):
    given = [("P", "a", 2), ("Q", "b", 3), ("P", "a", 2), ("P", "c", 2), ("Q", "d", 3), ("P", "e", 2)]
    frames = [spark.createDataFrame([g], "sample_id string, slide_id string, n_slides int") for g in given]
    assert rows(jobs.drain(processors.completed_samples(feed(spark, str(tmp_path), frames)), "g")) == [("P", 2)]


def test_throughput_updates(spark, tmp_path):
    df = stamped(spark, [(i * 600,) for i in range(100)], "done_at:bigint")
    frames = [df.where(F.col("done_at").cast("long") < 30000), df.where(F.col("done_at").cast("long") >= 30000)]
    counts = intake.throughput_windows(feed(spark, str(tmp_path), frames), "done_at", "1 hour").withColumn("start", F.col("window.start"))
    table = jobs.drain_updates(counts, ["start"], "t")
    want = df.groupBy(F.window("done_at", "6 hours").start.alias("start")).agg(F.count("*").alias("n"))
    assert rows(table, "start", "n") == rows(want, "start", "n")


def test_files_and_sheets(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for name in ("a.svs", "b.svs.part", "c.txt", ".d.svs"):
        (inbox / name).write_text("x" * 20)
    got = jobs.drain(intake.file_stream(spark, str(inbox), [".svs"], 10), "f")
    assert rows(got, "slide_id", "length") == [("a", 20)]
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    (sheets / "one.csv").write_text("slide_id,slide_path,sample_id,oncotree_code,file_id,file_name,needs_download\nA,/a.svs,P,,,,\nB,/b.svs,P,,,,\n")
    (sheets / "two.csv").write_text("slide_id,slide_path,sample_id,oncotree_code,file_id,file_name,needs_download\nC,/c.svs,P,,,,\n")
    rows_ = jobs.drain(intake.sheet_stream(spark, str(sheets)), "s")
    assert rows(intake.with_sheet_sizes(rows_), "slide_id", "n_slides") == [("A", 2), ("B", 2), ("C", 1)]


def test_hooks_run_in_order_and_once(spark, tmp_path):
    ran, broken = [], [True]
    hooks = jobs.Hooks()
    hooks.add("db_sync", lambda batch, batch_id, outdir: ran.append(("sync", outdir, batch.count())))
    hooks.add("wds", lambda batch, batch_id, outdir: ran.append(("wds", outdir, batch.count())))

    def coverage(batch, batch_id, outdir):
        if broken.pop() if broken else False:
            raise RuntimeError("first try fails")
        ran.append(("coverage", outdir, batch.count()))

    hooks.add("coverage", coverage)
    run = jobs.in_order(hooks.steps(outdir="o"), str(tmp_path / "done"))
    batch = spark.range(3)
    with pytest.raises(RuntimeError):
        run(batch, 0)
    run(batch, 0)
    run(batch, 0)
    assert ran == [("wds", "o", 3), ("coverage", "o", 3), ("sync", "o", 3)]


def test_state_table_steps_are_idempotent(spark, tmp_path):
    table = jobs.StateTable(spark, str(tmp_path / "state"))
    kinds = "slide_path string, slide_id string, status string, batch_id string, fail_count int, dispatched_at timestamp, error_msg string, first_seen_at timestamp, oncotree_code string, needs_download boolean"
    table.create(spark.createDataFrame([("p1", "a", "FAILED", "B", 1, None, "x", None, "", False)], kinds))
    step = jobs.intake_to_state(table, F.current_timestamp())
    arrivals = spark.createDataFrame([("p2", "b")], "slide_path string, slide_id string")
    step(arrivals, 0)
    step(arrivals, 0)
    jobs.retry_sweep(table, 3)(arrivals, 1)
    assert rows(table.read(), "slide_path", "status") == [("p1", "PENDING"), ("p2", "PENDING")]
    jobs.requeue_lost(table)(arrivals, 2)
    assert rows(table.read(), "slide_path", "status") == [("p1", "PENDING"), ("p2", "PENDING")]


def test_snapshots_and_exports_stream(spark, tmp_path):
    dated = "file_id string, updated_datetime string, first_seen_date date, removed_date date"
    inventory = jobs.StateTable(spark, str(tmp_path / "inv"))
    inventory.create(spark.createDataFrame([], dated))
    snap = lambda *ids: spark.createDataFrame([(i, "u") for i in ids], "file_id string, updated_datetime string")
    for batch_id, (ids, day) in enumerate([(("a", "b"), "2024-01-01"), (("b",), "2024-02-01"), (("a", "b"), "2024-03-01")]):
        jobs.snapshot_to_inventory(inventory, F.lit(day).cast("date"))(snap(*ids), batch_id)
    assert [(r.file_id, str(r.first_seen_date), r.removed_date) for r in inventory.read().orderBy("file_id").collect()] == [
        ("a", "2024-01-01", None), ("b", "2024-01-01", None)]
    target = jobs.StateTable(spark, str(tmp_path / "target"))
    target.create(spark.createDataFrame([("s1", "m", 1, "old")], "slide_id string, model string, at int, v string"))
    export = spark.createDataFrame([("s1", "m", 2, "new"), ("s1", "m", 1, "older"), ("s2", "m", None, "x")], "slide_id string, model string, at int, v string")
    jobs.export_merge(target, ["slide_id", "model"], "at")(export, 0)
    assert rows(target.read(), "slide_id", "v") == [("s1", "new"), ("s2", "x")]
    assert merge.latest_per_key(export, ["slide_id"], "at").count() == 2


def _files(folder):
    return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet")}


def test_bucket_table_rewrites_only_changed_buckets(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "id")
    table.create(spark.createDataFrame([(f"k{i}", i, "old") for i in range(400)], "id string, n int, v string"))
    table.create(spark.range(1).select(F.lit("never").alias("id")))
    first = _files(tmp_path / "t")
    assert len({f.split("/")[1] for f in first}) == 16 and table.versions() == [0]
    change = lambda t: t.withColumn("v", F.when(F.col("id") == "k7", "new").otherwise(F.col("v")))
    for touched in (None, lambda t: t.where("id = 'k7'")):
        version = table.versions()[-1] + 1
        assert len(table.advance(version, change if touched else lambda t: change(t).withColumn("v", F.concat("v", F.lit("")))
                                 , touched)) == 1
        assert table.advance(version, lambda t: t.limit(0)) == table.rewritten(version)
    assert first < _files(tmp_path / "t") and len({f.rsplit("/", 1)[0] for f in _files(tmp_path / "t") - first}) == 2
    assert table.read().count() == 400 and rows(table.read().where("v = 'new'"), "id", "n") == [("k7", 7)]
    assert table.read(0).where("v = 'new'").count() == 0 and {r.version for r in table.read(versions=True).where("id = 'k7'").collect()} == {2}
    assert table.advance(3, lambda t: t) == [] and table.read().count() == 400


def test_bucket_table_empties_grows_and_expires(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), buckets=4)
    table.create(spark.createDataFrame([], "id bigint, v string"))
    assert table.read().count() == 0
    new = spark.createDataFrame([(1, "a"), (2, None), (None, "n")], "id bigint, v string")
    table.advance(5, lambda t: t.unionByName(new), lambda _: new)
    assert rows(table.read()) == [(1, "a"), (2, None), (None, "n")]
    table.advance(6, lambda t: t.withColumn("extra", F.when(F.col("id") == 1, 9)), lambda t: t.where("id = 1"))
    assert rows(table.read(), "id", "v", "extra") == [(1, "a", 9), (2, None, None), (None, "n", None)]
    table.advance(7, lambda t: t.where("false"))
    assert table.read().count() == 0 and table.read(6).count() == 3
    before = len(_files(tmp_path / "t"))
    assert table.expire(keep=2) > 0 and len(_files(tmp_path / "t")) < before and table.read(6).count() == 3
    table.expire(keep=1)
    assert table.read().count() == 0 and table.read().columns == ["id", "v", "extra"]
    # A version that was cut off before its commit is not seen, and is written again.
    (tmp_path / "t" / "__version=000000000008" / "__bucket=0").mkdir(parents=True)
    assert table.versions()[-1] == 7
    table.advance(8, lambda t: t.unionByName(new, allowMissingColumns=True), lambda _: new)
    assert table.read().count() == 3


def test_steps_of_one_micro_batch_change_one_table(spark, tmp_path):
    table = jobs.StateTable(spark, str(tmp_path / "state"))
    kinds = "slide_path string, slide_id string, status string, batch_id string, fail_count int, dispatched_at timestamp, error_msg string, first_seen_at timestamp, oncotree_code string, needs_download boolean"
    table.create(spark.createDataFrame([(f"p{i}", f"s{i}", ("FAILED", "SUCCEEDED")[i % 2], "B", i % 5, None, "x", None, "", False) for i in range(60)], kinds))
    arrivals = spark.createDataFrame([("p1", "s1"), ("p70", "s70")], "slide_path string, slide_id string")
    steps = [("intake", jobs.intake_to_state(table, F.current_timestamp())), ("retry", jobs.retry_sweep(table, 2)), ("lost", jobs.requeue_lost(table))]
    run = jobs.in_order(steps, str(tmp_path / "done"))
    for batch_id in (0, 0, 1):
        run(arrivals, batch_id)
    want = {f"p{i}": "PENDING" if (i % 2 == 0 and i % 5 < 2) or i == 1 else ("FAILED", "SUCCEEDED")[i % 2] for i in range(60)} | {"p70": "PENDING"}
    assert {r.slide_path: r.status for r in table.read().collect()} == want
    assert len(table.versions()) == 7 and table.rewritten(20) and len(table.rewritten(20)) <= 2


def test_export_on_the_columns_both_sides_have(spark, tmp_path):
    target = jobs.StateTable(spark, str(tmp_path / "target"))
    target.create(spark.createDataFrame([("s1", 1, "kept", "old"), ("s3", 1, "k3", "o3")], "slide_id string, at int, own string, v string"))
    export = spark.createDataFrame([("s1", 2, "new", "x"), ("s2", 2, "two", "y")], "slide_id string, at int, v string, added string")
    jobs.export_merge(target, ["slide_id"], "at", evolve=False)(export, 0)
    assert target.read().columns == ["slide_id", "at", "own", "v"]
    assert rows(target.read()) == [("s1", 2, "kept", "new"), ("s2", 2, None, "two"), ("s3", 1, "k3", "o3")]


def test_late_rows_are_counted_over_all_micro_batches(spark, tmp_path):
    """The late rows come in early micro-batches, which the kept progress no longer holds."""
    # A watermark tells rows apart from the batch after the next on.
    seconds = [10_000, 10_500, 5_000, 11_000, 6_000, *range(12_000, 17_000, 1_000)]
    df = stamped(spark, [(s,) for s in seconds], "done_at:bigint")
    frames = [df.where(F.col("done_at").cast("long") == s) for s in seconds]
    counts = intake.throughput_windows(feed(spark, str(tmp_path / "in"), frames), "done_at", "1 minute", "10 minutes")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        def start():
            return (counts.writeStream.outputMode("append").format("noop").option("checkpointLocation", str(tmp_path / "p"))
                    .trigger(availableNow=True).start())
        with pytest.warns(UserWarning, match="2 rows came later"):
            assert jobs.run_to_end(start, spark) == 2
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_state_is_empty_after_the_span(spark, tmp_path):
    looks = [("a", 1, 10), ("b", 1, 10), ("a", 1, 100), ("tick", 9, 5_000), ("tick", 9, 9_000), ("tock", 9, 20_000), ("tock", 9, 20_500), ("end", 1, 40_000)]
    df = stamped(spark, [(p, n, 0, s) for p, n, s in looks], "path:string length:bigint modified:bigint observed_at:bigint")
    frames = [df.where(F.col("observed_at").cast("long") == s) for s in sorted({s for _, _, s in looks})]
    stream = processors.ready_files(feed(spark, str(tmp_path / "in"), frames), 60, keep_s=1000)
    got = jobs.drain(stream, "ready", str(tmp_path / "out"))
    # A key goes once the watermark, which follows a batch later, has passed its span.
    assert rows(got, "path", "length") == [("a", 1), ("tick", 9), ("tock", 9)]
    left = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "out" / "progress"))
    assert {r.key.path for r in left.collect()} <= {"tock", "end"}


def test_completed_samples_are_forgotten(spark, tmp_path):
    given = [("P", "a", 2, 5), ("P", "b", 2, 10), ("Q", "c", 3, 20), ("R", "d", 2, 9_000), ("X", "x", 9, 20_000), ("X", "y", 9, 25_000),
             ("R", "e", 2, 30_000), ("S", "f", 2, 60_000)]
    df = stamped(spark, given, "sample_id:string slide_id:string n_slides:int done_at:bigint")
    frames = [df.where(F.col("slide_id") == g[1]) for g in given]
    stream = processors.completed_samples(feed(spark, str(tmp_path / "in"), frames), "done_at", 1000)
    got = jobs.drain(stream, "done", str(tmp_path / "out"))
    assert rows(got) == [("P", 2)]
    left = spark.read.format("statestore").option("stateVarName", "count").load(str(tmp_path / "out" / "progress"))
    assert {r.key.sample_id for r in left.collect()} <= {"R", "S", "X"}


def test_each_bucket_is_written_by_its_own_task(spark, tmp_path):
    """Sixteen buckets of a first version, and the changed ones of a later version, are sixteen tasks' files, not several in one task."""
    table = BucketTable(spark, str(tmp_path / "t"), "id")
    table.create(spark.range(2000).select("id", F.lit(0).alias("v")))
    keys = spark.range(100, 104)
    changed = table.advance(1, lambda rows: rows.withColumn("v", F.lit(1)), lambda _: keys)
    for version, wanted in ((0, 16), (1, len(changed))):
        files = list((tmp_path / "t" / f"__version={version:012d}").glob("__bucket=*/part-*.parquet"))
        assert len(files) == len({f.name.split("-")[1] for f in files}) == wanted
    assert table.read().count() == 2000


def test_buckets_follow_the_rows():
    from lamella.sinks.buckets import buckets_for

    assert [buckets_for(n) for n in (0, 8_000_000, 8_000_001, 54_000_000)] == [16, 16, 17, 108]


class Cell:
    """Stands for a value, list or map state, and counts the writes to a map."""

    def __init__(self):
        self.value, self.map, self.writes = None, {}, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update

    def clear(self):
        self.value, self.map = None, {}

    def containsKey(self, key):
        return key in self.map

    def updateValue(self, key, value):
        self.map[key] = value
        self.writes += 1


def test_batches_of_one_key_are_walked_in_pieces(monkeypatch):
    """All arrivals of one key in one micro-batch: never more output at once than a piece, and the batches of a plain loop."""
    import pandas as pd

    monkeypatch.setattr(processors, "WALK_ROWS", 40)
    seen = [(i * 7919 % 1000, f"{i:04d}") for i in range(1000)]
    frame = pd.DataFrame({"slide_id": [s for _, s in seen], "arrived_at": pd.to_datetime([t // 3 for t, _ in seen], unit="s")})
    trigger = processors.BatchTrigger([6], 40)
    trigger.queue, trigger.head = Cell(), Cell()
    parts = list(trigger.handleInputRows(("q",), iter([frame[i:i + 90] for i in range(0, 1000, 90)]), None))
    assert len(parts) > 10 and max(len(p) for p in parts) < 40 + 6
    got = [s for p in parts for s in p["slide_id"]] + [s for s, _ in trigger.queue.value or []]
    assert got == [s for _, s in sorted((t // 3, s) for t, s in seen)]
    assert [n for p in parts for n in p["batch_no"]] == [i // 6 for i in range(996)]


@pytest.mark.parametrize("fresh,writes", [(100, 0), (4, 8)])
def test_a_sample_complete_at_once_writes_no_ids(monkeypatch, fresh, writes):
    import pandas as pd

    monkeypatch.setattr(processors, "FRESH", fresh)
    ids = [0, 1, 2, 2, 3, 4, 5, 5, 6, 7, 8, 9, 0]
    done = processors.GroupCompletion()
    done.handle, done.seen, done.count = None, Cell(), Cell()
    part = lambda x, n: iter([pd.DataFrame({"slide_id": [str(i) for i in y], "n_slides": n}) for y in (x[:5], x[5:]) if y])
    assert [tuple(r) for p in done.handleInputRows(("s",), part(ids, 10), None) for r in p.itertuples(index=False)] == [("s", 10)]
    assert done.seen.writes == writes and not done.seen.map and done.count.value == (10, True)
    open_ = processors.GroupCompletion()
    open_.handle, open_.seen, open_.count = None, Cell(), Cell()
    assert not list(open_.handleInputRows(("s",), part([1, 2, 2], 4), None)) and len(open_.seen.map) == 2
    assert [tuple(r) for p in open_.handleInputRows(("s",), part([2, 3, 4], 4), None) for r in p.itertuples(index=False)] == [("s", 4)]
    assert not open_.seen.map
