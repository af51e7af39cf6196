"""Whole polls and publications, and the registry itself."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lamella import schemas
from lamella.operators import sharding, state
from lamella.plans import ORACLES, QUERIES, flows
from lamella.session import stable
from lamella.sinks import tables
from lamella.sources import files, shards
from tests.conftest import rows
from tests.test_inventory_status import INVENTORY
from tests.test_state import table, view


def empty(spark, ddl):
    return spark.createDataFrame([], ddl)


def poll(spark, slides, results=(), remote=(), models=("m1",)):
    inventory = spark.createDataFrame([("f1", "S1.a.svs", "P", "DX1", "Primary Tumor", 10), ("f2", "S2.b.svs", "P", "DX1", "Primary Tumor", 10)], INVENTORY)
    return flows.poll_inventory(
        inventory, slides, list(models), spark.createDataFrame(list(results), "slide_id string, model string, path string"),
        empty(spark, schemas.SHARD_MANIFEST), empty(spark, "slide_id string, reason string"),
        empty(spark, "slide_id string, native_mpp double, mpp_is_fallback boolean"), F.current_timestamp(),
        paths={"remote": spark.createDataFrame([(k,) for k in remote], "key string"), "remote_base": "s3://b"}, max_retries=3)


def test_poll_fail_recover_succeed(spark):
    now = F.current_timestamp()
    first = poll(spark, table(spark).limit(0), remote=["f1/S1.a.svs"])
    assert view(first.next_state) == {"s3://b/f1/S1.a.svs": ("PENDING", None, 0), "gdc://f2/S2.b.svs": ("PENDING", None, 0)}
    again = poll(spark, first.next_state, remote=["f1/S1.a.svs"])
    assert view(again.next_state) == view(first.next_state)
    claims = first.next_state.select("slide_path", F.lit("B1").alias("batch_id"))
    flying = state.claim(first.next_state, claims, now)
    failed = state.complete_batches(stable(flying), spark.createDataFrame([("B1", 1, 600.0)], "batch_id string, exit_code int, duration_s double"), now)
    queued = stable(state.retry_failed(failed, 3))
    done = stable(state.complete_batches(state.claim(queued, claims, now), spark.createDataFrame([("B1", 0, 600.0)], "batch_id string, exit_code int, duration_s double"), now))
    assert {v for v in view(done).values()} == {("SUCCEEDED", "B1", 1)}
    settled = poll(spark, done, results=[("S1", "m1", "/r"), ("S2", "m1", "/r")], remote=["f1/S1.a.svs"])
    assert view(settled.next_state) == view(done) and settled.samples.count() == 0
    lost = poll(spark, done, results=[("S2", "m1", "/r")], remote=["f1/S1.a.svs"])
    assert view(lost.next_state)["s3://b/f1/S1.a.svs"] == ("PENDING", None, 0)


def test_poll_replaces_vanished_object(spark):
    before = table(spark, ("s3://b/f1/S1.a.svs", "S1", "FAILED", None, 1))
    after = view(poll(spark, before, remote=["f2/S2.b.svs"]).next_state)
    assert after == {"gdc://f1/S1.a.svs": ("PENDING", None, 0), "s3://b/f2/S2.b.svs": ("PENDING", None, 0)}


def test_append_twice(spark, tmp_path):
    dest = str(tmp_path / "wds")
    ids = [f"s{i}" for i in range(6)]
    features = spark.createDataFrame([(s, "m", t, [float(t)] * 4, "float32") for s in ids for t in range(3)],
                                     "slide_id string, model string, tile_idx int, features array<float>, precision string")
    found = spark.createDataFrame([(s, 48) for s in ids], "slide_id string, bytes bigint")
    routing = spark.createDataFrame([(s, "A" if i < 4 else "B") for i, s in enumerate(ids[:5])], "slide_id string, project_id string")
    meta = empty(spark, "slide_id string, native_mpp double, mpp_is_fallback boolean")
    none = empty(spark, "project_id string, shard_file string, length bigint")
    one = flows.append_shards(features, found.where("slide_id < 's3'"), empty(spark, schemas.SHARD_INDEX), routing, meta, none, "m", dest, 100)
    assert rows(one.index, "slide_id", "shard_file") == [("s0", "A/000000.tar"), ("s1", "A/000000.tar"), ("s2", "A/000001.tar")]
    existing = one.index.select("project_id", F.element_at(F.split("shard_file", "/"), -1).alias("shard_file"), F.lit(1).cast("bigint").alias("length"))
    two = flows.append_shards(features, found, one.index, routing, meta, existing, "m", dest, 100)
    assert rows(two.index, "slide_id", "shard_file")[3:] == [("s3", "A/000002.tar"), ("s4", "B/000000.tar")]
    assert tuple(sharding.run_summary(two.planned).first()) == (2, 3, 1)
    assert rows(two.entries, "slide_id") == [("s3",), ("s4",)]
    back = shards.shard_scan(spark, dest)
    assert back.select("slide_id").distinct().count() == 5 and back.count() == 15
    three = flows.append_shards(features, found, two.index, routing, meta, existing, "m", dest, 100, dry_run=True)
    assert sharding.run_summary(three.planned).first().n_appended == 0


def test_append_continues_the_open_shard(spark, tmp_path):
    """Three appends to one shard; a reader of the index in between keeps what it has."""
    dest, folder = str(tmp_path / "wds"), str(tmp_path / "index")
    ids = [f"s{i}" for i in range(7)]
    features = spark.createDataFrame([(s, "m", t, [float(ids.index(s))] * 4, "float32") for s in ids for t in range(3)],
                                     "slide_id string, model string, tile_idx int, features array<float>, precision string")
    routing = spark.createDataFrame([(s, "A") for s in ids], "slide_id string, project_id string")
    meta = empty(spark, "slide_id string, native_mpp double, mpp_is_fallback boolean")
    held = []
    for upto in (2, 5, 6):
        found = spark.createDataFrame([(s, 48) for s in ids[:upto]], "slide_id string, bytes bigint")
        listed = files.shard_listing(spark, dest).select(F.element_at(F.split("path", "/"), -2).alias("project_id"),
                                                         F.element_at(F.split("path", "/"), -1).alias("shard_file"), "length")
        index = files.current_index(spark, folder, schemas.SHARD_INDEX)
        held.append(index)
        out = flows.append_shards(features, found, index, routing, meta, listed, "m", dest, 1 << 20, continue_open=True)
        tables.index_sink(out.index, folder)
        assert rows(out.entries, "slide_id") == [(s,) for s in ids[:upto]]
    assert rows(held[1], "shard_file") == [("A/000000.tar",)] * 2 and rows(held[2], "shard_file") == [("A/000000.r1.tar",)] * 5
    now = files.current_index(spark, folder, schemas.SHARD_INDEX)
    assert rows(now, "slide_id", "shard_file") == [(s, "A/000000.r2.tar") for s in ids[:6]]
    back = shards.shard_scan(spark, dest)
    assert back.count() == 18 and {(r.slide_id, r.features[0]) for r in back.collect()} == {(s, float(i)) for i, s in enumerate(ids[:6])}
    listed = files.shard_listing(spark, dest).withColumn("shard_file", F.element_at(F.split("path", "/"), -1))
    assert rows(sharding.superseded(listed, ["model"]), "shard_file") == [("000000.r1.tar",), ("000000.tar",)]
    # A full shard is left alone.
    more = flows.append_shards(features, spark.createDataFrame([("s6", 48)], "slide_id string, bytes bigint"), now, routing, meta,
                               listed.withColumn("project_id", F.lit("A")), "m", dest, 100, continue_open=True)
    assert rows(more.index.where("slide_id = 's6'"), "shard_file") == [("A/000001.tar",)] and more.entries.count() == 1


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["status_pivot", "inventory_scd_merge", "shard_by_bytes", "roc_auc", "subsample_equal", "rotating_batches", "size_or_time_batches", "tile_class_shares", "status_sync"])
def test_queries_on_several_chunks(spark, name):
    """Queries against their SQL twins in a session that really cuts data into chunks."""
    from check import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, result.fetchall())


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
