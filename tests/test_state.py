import pytest
from pyspark.sql import functions as F

from lamella import schemas
from lamella.operators import batching, manifest, merge, progress, resolve, sharding, state
from tests.conftest import rows



@pytest.fixture(scope="module")
def now(spark):
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def table(spark, *entries):
    """State rows from (path, id, status, batch, fails)."""
    base = spark.createDataFrame(list(entries), "slide_path string, slide_id string, status string, batch_id string, fail_count int")
    names = schemas.names(schemas.SLIDE_STATE)
    kinds = dict(e.split() for e in schemas.SLIDE_STATE.split(", "))
    return base.select(*[F.col(c) if c in base.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])


def view(df):
    return {r.slide_path: (r.status, r.batch_id, r.fail_count) for r in df.collect()}


def test_insert_only_new_paths(spark, now):
    old = table(spark, ("p1", "a", "FAILED", None, 2))
    arrivals = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p2", "b")], "slide_path string, slide_id string")
    got = view(state.insert_new(old, arrivals, now))
    assert got == {"p1": ("FAILED", None, 2), "p2": ("PENDING", None, 0)}


def test_claim_is_conditional_and_idempotent(spark, now):
    old = table(spark, ("p1", "a", "PENDING", None, 0), ("p2", "b", "DISPATCHED", "B0", 0), ("p3", "c", "PENDING", None, 0))
    wanted = spark.createDataFrame([("p1", "B1"), ("p2", "B1"), ("zz", "B1")], "slide_path string, batch_id string")
    once = state.claim(old, wanted, now)
    assert view(once) == {"p1": ("DISPATCHED", "B1", 0), "p2": ("DISPATCHED", "B0", 0), "p3": ("PENDING", None, 0)}
    assert view(state.claim(once, wanted, now)) == view(once)
    assert rows(state.claimed_counts(once)) == [("B0", 1), ("B1", 1)]


def test_batch_results(spark, now):
    old = table(spark, ("p1", "a", "DISPATCHED", "ok", 0), ("p2", "b", "DISPATCHED", "bad", 0), ("p3", "c", "FAILED", "bad", 1),
                ("p4", "d", "SUCCEEDED", "bad", 0), ("p5", "e", "DISPATCHED", "quick", 0), ("p6", "f", "DISPATCHED", "other", 0))
    results = spark.createDataFrame([("ok", 0, 900.0), ("bad", 1, 60.0), ("quick", 1, 59.0)], "batch_id string, exit_code int, duration_s double")
    assert view(state.complete_batches(old, results, now)) == {
        "p1": ("SUCCEEDED", "ok", 0), "p2": ("FAILED", "bad", 1), "p3": ("FAILED", "bad", 2), "p4": ("SUCCEEDED", "bad", 0),
        "p5": ("PENDING", None, 0), "p6": ("DISPATCHED", "other", 0)}


def test_slide_results_charge_nothing(spark, now):
    old = table(spark, ("p1", "a", "DISPATCHED", "B", 1), ("p2", "b", "DISPATCHED", "B", 0))
    results = spark.createDataFrame([("p1", "B", False), ("p2", "X", True)], "slide_path string, batch_id string, ok boolean")
    assert view(state.complete_slides(old, results, now)) == {"p1": ("FAILED", "B", 1), "p2": ("DISPATCHED", "B", 0)}


def test_retry_budget(spark):
    old = table(spark, ("p1", "a", "FAILED", "B", 2), ("p2", "b", "FAILED", "B", 3), ("p3", "c", "SUCCEEDED", "B", 0))
    assert view(state.retry_failed(old, 3)) == {"p1": ("PENDING", None, 2), "p2": ("FAILED", "B", 3), "p3": ("SUCCEEDED", "B", 0)}
    assert view(state.retry_failed(old, 0))["p2"] == ("PENDING", None, 3)


def test_exhausted_rows_never_come_back(spark, now):
    current = table(spark, ("p1", "a", "DISPATCHED", "B", 2))
    failed = spark.createDataFrame([("B", 1, 900.0)], "batch_id string, exit_code int, duration_s double")
    current = state.retry_failed(state.complete_batches(current, failed, now), 3)
    assert view(current) == {"p1": ("FAILED", "B", 3)}
    assert state.pending_slides(current).count() == 0
    assert progress.exhausted(current, 3).first()[0] == 1


def test_lost_outputs(spark):
    old = table(spark, ("p1", "a", "SUCCEEDED", "B", 2), ("p2", "b", "FAILED", "B", 2), ("p3", "c", "SUCCEEDED", "B", 0))
    lost = spark.createDataFrame([("p1",), ("p2",)], "slide_path string")
    assert view(state.requeue_lost(old, lost)) == {"p1": ("PENDING", None, 0), "p2": ("FAILED", "B", 2), "p3": ("SUCCEEDED", "B", 0)}


def test_blacklist_known_and_unknown(spark, now):
    old = table(spark, ("p1", "a", "PENDING", "B", 0), ("p2", "a", "SUCCEEDED", "B", 0), ("p3", "c", "PENDING", None, 0))
    listed = spark.createDataFrame([("a", "bad"), ("x", "gone"), ("y", "gone")], "slide_id string, reason string")
    got = view(state.blacklist(old, listed, now, 5))
    assert got == {"p1": ("FAILED", None, 5), "p2": ("FAILED", None, 5), "p3": ("PENDING", None, 0),
                   "tombstone://x": ("FAILED", None, 5), "tombstone://y": ("FAILED", None, 5)}
    assert view(state.retry_failed(state.blacklist(old, listed, now, 5), 5))["tombstone://x"][0] == "FAILED"


def test_coverage(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "slide_id string")
    entries = spark.createDataFrame([("a", "m1"), ("a", "m2"), ("a", "m2"), ("b", "m1"), ("c", "m9")], "slide_id string, model string")
    missing = state.uncovered(batch, entries, ["m1", "m2"])
    assert rows(missing) == [("b",), ("c",)]
    old = table(spark, ("p1", "a", "SUCCEEDED", "B", 0), ("p2", "b", "SUCCEEDED", "B", 0), ("p3", "c", "SUCCEEDED", "B", 2), ("p4", "b", "FAILED", "B", 0))
    assert view(state.apply_coverage(old, missing, 3)) == {
        "p1": ("SUCCEEDED", "B", 0), "p2": ("PENDING", None, 1), "p3": ("FAILED", None, 3), "p4": ("FAILED", "B", 0)}
    assert view(state.apply_coverage(old, missing, 0))["p3"] == ("PENDING", None, 3)


def test_download_admission(spark):
    old = table(spark, ("s3://b/1", "s1", "PENDING", None, 0), ("gdc://f2/n", "s2", "PENDING", None, 0), ("/d/3", "s3", "SUCCEEDED", None, 0),
                ("s3://b/4", "s4", "FAILED", None, 5), ("s3://b/5", "s5", "FAILED", None, 1))
    wanted = spark.createDataFrame([(f"s{i}", f"f{i}", "n") for i in range(1, 7)] + [("s7", "", "n")], "slide_id string, file_id string, file_name string")
    admitted = resolve.admit_downloads(wanted, old, 5)
    assert rows(admitted, "slide_id") == [("s5",), ("s6",)]
    assert "s3://b/5" not in view(state.drop_stale_remote(old, admitted))
    assert "s3://b/1" in view(state.drop_stale_remote(old, admitted))
    assert rows(resolve.admit_downloads(wanted, old, 0), "slide_id") == [("s4",), ("s5",), ("s6",)]


def test_recovery(spark, now):
    ids = ["20240531T230000_aaaaaaaa", "20240531T230001_bbbbbbbb", "20240531T230002_cccccccc", "20240501T000000_dddddddd",
           "20240531T230003_eeeeeeee", "20240531T230004_ffffffff", "20240531T230005_99999999"]
    given = [(ids[0], "RUNNING", 1, True, True), (ids[1], "RUNNING", None, True, True), (ids[2], "RUNNING", 3, False, True),
             (ids[3], "RUNNING", 4, True, True), (ids[4], "SUCCEEDED", 5, True, True), (ids[5], "RUNNING", 6, True, True), (ids[6], "RUNNING", 7, True, False)]
    batches = spark.createDataFrame(given, "batch_id string, status string, pid int, alive boolean, resumable boolean").withColumns(
        {"completed_at": F.lit(None).cast("timestamp"), "exit_code": F.lit(None).cast("int")})
    got = {r.batch_id: r.recovery for r in state.recover_batches(batches, now, 1).collect()}
    assert [got[i] for i in ids] == ["resume", "reset", "reset", "reset", None, "reset", "reset"]
    recovered = state.recover_batches(batches, now, 1)
    slides = table(spark, ("p1", "a", "DISPATCHED", ids[0], 0), ("p2", "b", "DISPATCHED", ids[1], 0), ("p3", "c", "FAILED", ids[1], 1))
    assert view(state.apply_recovery(slides, recovered)) == {"p1": ("DISPATCHED", ids[0], 0), "p2": ("PENDING", None, 0), "p3": ("FAILED", ids[1], 1)}
    closed = {r.batch_id: (r.status, r.exit_code) for r in state.close_reset_batches(recovered, now).collect()}
    assert closed[ids[1]] == ("FAILED", -1) and closed[ids[0]] == ("RUNNING", None)


def test_batch_rows_and_migration(spark, now):
    b = spark.createDataFrame([("b1", "RUNNING", None), ("b2", "FAILED", 1)], "batch_id string, status string, exit_code int").withColumn(
        "completed_at", F.lit(None).cast("timestamp"))
    assert {r.batch_id: r.status for r in state.restart_batches(b, b.where("batch_id = 'b2'")).collect()} == {"b1": "RUNNING", "b2": "RUNNING"}
    assert rows(state.cancel_batches(b, b.where("batch_id = 'b1'")), "batch_id") == [("b2",)]
    done = state.finish_batches(b, spark.createDataFrame([("b1", 0)], "batch_id string, exit_code int"), now)
    assert rows(done, "batch_id", "status") == [("b1", "SUCCEEDED"), ("b2", "FAILED")]
    up = state.upsert(b, spark.createDataFrame([("b1", "X"), ("b3", "Y")], "batch_id string, status string"), "batch_id")
    assert rows(up, "batch_id", "status") == [("b1", "X"), ("b2", "FAILED"), ("b3", "Y")]
    old = spark.createDataFrame([("b", "s")], "batch_id string, old_session_id string")
    new = state.migrate(old, {"old_session_id": "session_id"}, {"pid": F.lit(None).cast("int")})
    assert new.columns == ["batch_id", "session_id", "pid"]
    assert state.migrate(new, {"old_session_id": "session_id"}, {"pid": F.lit(1)}).columns == new.columns


def test_sheet_prefers_real_paths(spark):
    given = [(1, "s1", "gdc://f1/n1", None, None, True), (2, "s1", "s3://b/1", None, None, False), (3, "s1", "s3://b/late", None, None, False),
             (4, "s2", "gdc://f2/n2", "", "", True), (5, "s3", "", None, None, False), (6, "s4", "name.svs", None, None, True)]
    df = spark.createDataFrame(given, "n int, slide_id string, slide_path string, file_id string, file_name string, needs_download boolean")
    got = {r.slide_id: tuple(r)[1:] for r in batching.batch_sheet(df.withColumn("oncotree_code", F.lit(None).cast("string")), "n").collect()}
    assert got == {"s1": ("s3://b/1", "", False, None, None), "s2": ("gdc://f2/n2", "", True, "f2", "n2")}


def test_merge_and_latest(spark):
    target = spark.createDataFrame([(1, "m", "old", 7), (2, "m", "old", 8)], "id int, model string, v string, extra int")
    source = spark.createDataFrame([(1, "m", "new", True), (3, "m", "ins", False)], "id int, model string, v string, added boolean")
    full = merge.merge(target, source, ["id", "model"])
    assert full.columns == ["id", "model", "v", "extra", "added"]
    assert rows(full) == [(1, "m", "new", 7, True), (3, "m", "ins", None, False)]
    kept = merge.merge(target, source, ["id", "model"], delete_missing=False, evolve=False)
    assert rows(kept) == [(1, "m", "new", 7), (2, "m", "old", 8), (3, "m", "ins", None)]
    log = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c")], "id int, at int, v string")
    assert rows(merge.latest_per_key(log, ["id"], "at"), "id", "v") == [(1, "b"), (2, "c")]
    assert merge.add_missing_columns(target, source).columns == ["id", "model", "v", "extra", "added"]


def test_index_prune_scope_and_append_idempotence(spark):
    index = spark.createDataFrame([("m", "a", "g"), ("m", "b", "g"), ("m", "c", "g")], "model string, slide_id string, project_id string")
    failed, batch = (spark.createDataFrame([(s,) for s in ids], "slide_id string") for ids in (("a", "b"), ("b", "c")))
    assert rows(sharding.prune_index(index, failed, batch), "slide_id") == [("a",), ("c",)]
    assert rows(sharding.prune_index(index, failed), "slide_id") == [("c",)]
    found = spark.createDataFrame([("a",), ("d",), ("e",)], "slide_id string")
    routing = spark.createDataFrame([("a", "g"), ("d", " g "), ("e", " ")], "slide_id string, project_id string")
    plan = sharding.plan_append(found, index, routing, "m")
    assert rows(plan, "slide_id", "fate", "project_id") == [("a", "indexed", "g"), ("d", "append", "g"), ("e", "no_group", "")]
    assert tuple(sharding.run_summary(plan).first()) == (1, 1, 1)
    new = plan.where("fate = 'append'").withColumn("shard_file", F.lit("000000.tar"))
    meta = spark.createDataFrame([("d", 0.25, False)], "slide_id string, native_mpp double, mpp_is_fallback boolean")
    full = sharding.extend_index(index.withColumns({"shard_file": F.lit("g/000000.tar"), "native_mpp": F.lit(None).cast("double"), "mpp_is_fallback": F.lit(None).cast("boolean")}), new, "m", meta)
    again = sharding.plan_append(found, full, routing, "m")
    assert sharding.run_summary(again).first().n_appended == 0
    entries = sharding.manifest_entries(full, new, "s3://w/", batch)
    assert rows(entries, "slide_id", "wds_path") == [(s, "s3://w/m/g/000000.tar") for s in ("b", "c", "d")]


def test_progress_never_exceeds_inventory(spark):
    entries = [(f"s{i}", m, f"w{i % 3}") for m in ("m1", "m2") for i in range(5)] + [("s0", "m1", "w9"), ("", "m1", "w9")]
    df = spark.createDataFrame(entries, "slide_id string, model string, wds_path string")
    assert rows(manifest.unique_slides(df)) == [("m1", 5), ("m2", 5)]
    assert tuple(manifest.done_counts(df, ["m1", "m2"], F.lit(4)).first()) == (4, 4)
    assert tuple(manifest.done_counts(df, ["m1", "m2", "none"]).first()) == (0, 0)
    split = spark.createDataFrame([("a", "m1", ""), ("b", "m2", "")], "slide_id string, model string, wds_path string")
    assert tuple(manifest.done_counts(split, ["m1", "m2"]).first()) == (1, 0)
    assert rows(manifest.shard_distribution(df)) == [("m1", 4, 1.8, 1, 2), ("m2", 3, 1.7, 1, 2)]


def test_throughput(spark):
    base = [("SUCCEEDED", "2024-05-31 22:00:00"), ("SUCCEEDED", "2024-05-31 23:30:00"), ("SUCCEEDED", "2024-05-30 00:00:00"), ("PENDING", None), ("DISPATCHED", None)]
    df = spark.createDataFrame(base, "status string, at string").withColumn("completed_at", F.col("at").cast("timestamp"))
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    got = progress.throughput(df, now, 6, F.lit(3)).first()
    assert (got.completed_in_window, got.throughput_per_hour, got.remaining, got.eta_seconds, got.eta) == (2, 1.0, 5, 18000, "5h 0m")
    few = progress.throughput(df.where("at <> '2024-05-31 22:00:00' OR at IS NULL"), now).first()
    assert few.throughput_per_hour is None and few.eta is None


def test_backfill_progress(spark):
    stored = spark.createDataFrame([("b1", 5, 10, 2), ("b2", 9, 10, 5), ("b3", None, None, None)], "batch_id string, tasks_done int, tasks_total int, tasks_failed int")
    have = spark.createDataFrame([("b1", 1, 1, 1)], "batch_id string, succeeded int, failed int, pending int")
    assert rows(state.backfill_progress(stored, have)) == [("b1", 1, 1, 1), ("b2", 9, 5, 0)]


def test_repeated_keys_multiply_nothing(spark, now):
    old = table(spark, ("p1", "a", "DISPATCHED", "B", 0), ("p2", "b", "PENDING", None, 0), ("p3", "c", "PENDING", None, 0))
    results = spark.createDataFrame([("B", 0, 900.0), ("B", 1, 500.0), ("B", 1, 700.0), (None, 1, 1.0)], "batch_id string, exit_code int, duration_s double")
    assert view(state.complete_batches(old, results, now)) == {"p1": ("FAILED", "B", 1), "p2": ("PENDING", None, 0), "p3": ("PENDING", None, 0)}
    values = spark.createDataFrame([("p1", "x"), ("p1", "y")], "slide_path string, slide_id string")
    assert rows(state.set_attributes(old, values, "slide_path"), "slide_path", "slide_id") == [("p1", "y"), ("p2", "b"), ("p3", "c")]
    target = spark.createDataFrame([(1, "old"), (2, "stay")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "a"), (3, "new")], "k int, v string")
    assert rows(merge.merge(target, source, ["k"], delete_missing=False)) == [(1, "b"), (2, "stay"), (3, "new")]
    assert rows(state.upsert(target, source, "k")) == [(1, "b"), (2, "stay"), (3, "new")]
    recovered = spark.createDataFrame([("B", "reset")], "batch_id string, recovery string")
    assert view(state.apply_recovery(old, recovered))["p1"] == ("PENDING", None, 0)
