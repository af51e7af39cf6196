from datetime import date

import pytest
from pyspark.sql import functions as F

from lamella.operators import inventory, resolve, status
from tests.conftest import rows

OLD = "file_id string, label string, updated_datetime string, first_seen_date date, removed_date date"
NEW = "file_id string, label string, updated_datetime string"
DAY = F.lit


def _merge(spark, old, new, day="2024-06-01"):
    return inventory.scd_merge(spark.createDataFrame(old, OLD), spark.createDataFrame(new, NEW), F.lit(day).cast("date"))


def _d(s):
    return date.fromisoformat(s) if s else None


def test_scd_cases(spark):
    old = [("keep", "k", "u1", _d("2024-01-01"), None), ("gone", "g", "u1", _d("2024-01-01"), None),
           ("gone_before", "b", "u1", _d("2024-01-01"), _d("2024-02-01")), ("back", "r", "u1", _d("2024-01-01"), _d("2024-02-01")),
           ("changed", "c", "u1", _d("2024-01-01"), None)]
    new = [("keep", "k", "u1"), ("back", "r", "u1"), ("changed", "c2", "u2"), ("fresh", "f", "u1")]
    got = {r.file_id: (r.label, r.first_seen_date, r.removed_date, r.change) for r in _merge(spark, old, new).collect()}
    first, sync = _d("2024-01-01"), _d("2024-06-01")
    assert got == {
        "keep": ("k", first, None, "unchanged"), "gone": ("g", first, sync, "removed"),
        "gone_before": ("b", first, _d("2024-02-01"), "unchanged"), "back": ("r", first, None, "reappeared"),
        "changed": ("c2", first, None, "updated"), "fresh": ("f", sync, None, "added")}


def test_removed_date_never_stamped_twice(spark):
    old = [("a", "x", "u", _d("2024-01-01"), None)]
    once = _merge(spark, old, [], "2024-02-01").drop("change")
    twice = inventory.scd_merge(once, spark.createDataFrame([], NEW), F.lit("2024-03-01").cast("date"))
    assert twice.first().removed_date == _d("2024-02-01")
    assert inventory.change_counts(twice).first().n_removed == 0


def test_snapshot_at(spark):
    df = spark.createDataFrame([("aaa", "", "", _d("2024-01-01"), None), ("bbb", "", "", _d("2024-01-01"), _d("2024-05-01")),
                                ("ccc", "", "", _d("2024-04-01"), None)], OLD)
    at = lambda s: [r[0] for r in rows(inventory.snapshot_at(df, F.lit(s).cast("date")), "file_id")]
    assert at("2024-03-01") == ["aaa", "bbb"]
    assert at("2024-06-01") == ["aaa", "ccc"]


def test_first_inventory_and_backfill(spark):
    new = spark.createDataFrame([("a", "x", "u")], NEW)
    got = inventory.first_inventory(new, F.lit("2024-06-01").cast("date")).first()
    assert (got.first_seen_date, got.removed_date) == (_d("2024-06-01"), None)
    assert inventory.backfill_temporal(new).columns[-2:] == ["first_seen_date", "removed_date"]


INVENTORY = "file_id string, file_name string, project_id string, slide_type string, sample_type string, file_size bigint"


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([
        ("f1", "S1.a.svs", "P-A", "DX1", "Primary Tumor", 100), ("f2", "S2.b.svs", "P-A", "DX10", "Metastatic", 200),
        ("f3", "S3.c.svs", "P-B", "BS1", "Blood Derived Normal", 0), ("f4", "S4.d.svs", "P-B", "TS1", "Primary Tumor", 400)], INVENTORY)


def test_status_precedence(spark, files):
    results = spark.createDataFrame([("S1", "m1", "/r/S1")], "slide_id string, model string, path string")
    shards = spark.createDataFrame([("S1", "m1", "s3://w1"), ("S2", "m1", "s3://w2"), ("S3", "m2", "")], "slide_id string, model string, wds_path string")
    failures = spark.createDataFrame([("S2", "boom"), ("S3", "lost")], "slide_id string, reason string")
    mpp = spark.createDataFrame([("S1", 0.25, False), ("S2", None, True)], "slide_id string, native_mpp double, mpp_is_fallback boolean")
    out = status.build_status(files, ["m1", "m2"], results, shards, failures, mpp, F.current_timestamp())
    got = {(r.slide_id, r.model): (r.status, r.wds_path, r.failure_reason, r.tiling_mpp) for r in out.collect()}
    assert len(got) == 8
    assert got["S1", "m1"] == ("done", "/r/S1", "", 0.25)
    assert got["S2", "m1"] == ("done", "s3://w2", "", 0.5)
    assert got["S2", "m2"] == ("failed", "", "boom", 0.5)
    assert got["S3", "m2"] == ("failed", "", "lost", None)
    assert got["S4", "m1"] == ("pending", "", "", None)
    pivot = {(r.project_id, r.model): (r.done, r.failed, r.pending) for r in status.status_pivot(out).collect()}
    assert pivot["P-A", "m1"] == (2, 0, 0) and pivot["P-B", "m2"] == (0, 1, 1)


def test_export_status_wins_and_fills_blanks(spark, files):
    st = spark.createDataFrame([("f1", "S1", "", "DX1x", "m", "0.5", "True"), ("zz", "S9", "P", "", "m", "bad", "")],
                               "file_id string, slide_id string, project_id string, slide_type string, model string, native_mpp string, mpp_is_fallback string")
    got = {r.file_id: r for r in status.export_with_inventory(st, files).collect()}
    assert (got["f1"].project_id, got["f1"].slide_type, got["f1"].native_mpp, got["f1"].mpp_is_fallback, got["f1"].file_size) == ("P-A", "DX1x", 0.5, True, 100.0)
    assert (got["zz"].native_mpp, got["zz"].mpp_is_fallback, got["zz"].file_name) == (None, None, None)


def test_state_export(spark):
    slides = spark.createDataFrame([("p1", "S1", "DISPATCHED", None, 1), ("p2", "S1", "FAILED", None, 2), ("p3", "S2", "SUCCEEDED", "old error", 3), ("p4", "", "FAILED", "x", 4)],
                                   "slide_path string, slide_id string, status string, error_msg string, n int")
    slides = slides.withColumns({"oncotree_code": F.lit(None).cast("string"), "first_seen_at": F.lit(None).cast("timestamp"), "completed_at": F.lit(None).cast("timestamp")})
    shards = spark.createDataFrame([("S2", "uni", "s3://w")], "slide_id string, model string, wds_path string")
    one = spark.range(1)
    assert rows(status.fan_out(one, status.models_or_unknown(shards, None)), "model") == [("uni",)]
    assert rows(status.fan_out(one, status.models_or_unknown(shards.limit(0), [])), "model") == [("unknown",)]
    assert status.models_or_unknown(shards, ["a", "b"]) == ["a", "b"]
    out = status.export_from_state(slides, shards, ["uni", "gig"], F.col("n"))
    got = {(r.slide_id, r.model): (r.slide_path, r.status, r.failure_reason, r.wds_path) for r in out.collect()}
    assert got == {("S1", "uni"): ("p2", "FAILED", "", ""), ("S1", "gig"): ("p2", "FAILED", "", ""),
                   ("S2", "uni"): ("p3", "SUCCEEDED", "", "s3://w"), ("S2", "gig"): ("p3", "SUCCEEDED", "", "")}


def test_pending_filters(spark, files):
    st = spark.createDataFrame([("S1", "m1", "done"), ("S2", "m2", "done"), ("S2", "m1", "pending")], "slide_id string, model string, status string")
    ids = lambda df: [r[0] for r in rows(df, "slide_id")]
    assert ids(resolve.pending(files, resolve.done_slides(st))) == ["S3", "S4"]
    assert ids(resolve.pending(files, resolve.done_slides(st, ["m1", "m2"], "first"))) == ["S2", "S3", "S4"]
    assert ids(resolve.pending(files, resolve.done_slides(st, ["m1", "m2"], "all"))) == ["S1", "S2", "S3", "S4"]
    assert ids(resolve.pending(files, slide_types="DX1")) == ["S1", "S2"]
    assert ids(resolve.pending(files, slide_types="DX1", exact_type=True)) == ["S1"]
    assert ids(resolve.pending(files, slide_types="BS,TS", projects="P-B", sample_types="tumor")) == ["S4"]
    assert [r.slide_id for r in resolve.pending(files, limit=2).collect()] == ["S1", "S2"]


def _resolved(spark, files, **kw):
    slides = files.withColumn("slide_id", F.substring_index("file_name", ".", 1))
    return {r.slide_id: (r.slide_path, r.needs_download) for r in resolve.resolve_paths(slides, **kw).collect()}


def test_resolution_order(spark, files):
    local = spark.createDataFrame([("f1/S1.a.svs", 100), ("f2/S2.b.svs", 150), ("f3/S3.c.svs", 7)], "key string, length bigint")
    remote = spark.createDataFrame([("f2/S2.b.svs",), ("f1/S1.a.svs",)], "key string")
    got = _resolved(spark, files, local=local, local_root="/loc/", remote=remote, remote_base="s3://b/p/")
    assert got == {"S1": ("/loc/f1/S1.a.svs", False), "S2": ("s3://b/p/f2/S2.b.svs", False),
                   "S3": ("/loc/f3/S3.c.svs", False), "S4": ("/loc/f4/S4.d.svs", True)}


def test_resolution_without_listing(spark, files):
    assert _resolved(spark, files, remote_base="s3://b")["S4"] == ("s3://b/f4/S4.d.svs", False)
    assert _resolved(spark, files)["S4"] == ("", True)
    nothing = spark.createDataFrame([], "key string")
    assert _resolved(spark, files, remote_base="s3://b", remote=nothing)["S4"] == ("", True)
    assert _resolved(spark, files, remote_base="s3://b", remote=nothing, unknown_is_present=True)["S4"][1] is False


def test_existence(spark):
    slides = spark.createDataFrame([("a", "s3://b/1"), ("b", "s3://b/2"), ("c", "/disk/3")], "slide_id string, slide_path string")
    listing = spark.createDataFrame([("s3://b/1",)], "uri string")
    usable, missing = resolve.split_by_existence(resolve.check_exists(slides, listing))
    assert rows(usable, "slide_id") == [("a",), ("c",)] and rows(missing, "slide_id") == [("b",)]
    unknown = resolve.check_exists(slides, None)
    assert rows(resolve.split_by_existence(unknown)[0], "slide_id") == [("a",), ("b",), ("c",)]
    assert rows(resolve.split_by_existence(unknown, False)[1], "slide_id") == [("a",), ("b",)]
