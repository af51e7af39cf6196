"""Ordered operators against plain loops, on data cut into several chunks."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lamella.operators import batching, ordered, sharding
from tests.conftest import rows


def _pack(sizes, cap, first=0, held=None):
    """Next-fit in a loop."""
    out, shard, filled = [], first, held
    for size in sizes:
        if filled is not None and filled + size > cap:
            shard, filled = shard + 1, 0
        filled = (filled or 0) + size
        out.append(shard)
    return out


@pytest.mark.parametrize("seed,cap,top", [(1, 50, 20), (2, 10, 25), (3, 1000, 9), (4, 7, 7)])
def test_next_fit_equals_loop(spark, seed, cap, top):
    rng = random.Random(seed)
    data = [(g, i, rng.randint(0, top)) for g in "abc" for i in range({"a": 400, "b": 37, "c": 1}[g])]
    df = spark.createDataFrame(data, "g string, id int, size int").repartition(5)
    got = {(r.g, r.id): r.shard for r in sharding.assign_by_bytes(df, ["g"], ["id"], "size", cap).collect()}
    for g in "abc":
        mine = [(i, s) for gg, i, s in data if gg == g]
        assert [got[(g, i)] for i, _ in mine] == _pack([s for _, s in mine], cap)


def test_chunks_are_really_several(spark):
    df = spark.range(1000).withColumn("g", F.lit("hot"))
    assert ordered.chunked(df, ["g"], ["id"]).select("__chunk").distinct().count() > 1


def test_next_fit_continues_open_shard(spark):
    rng = random.Random(9)
    data = [(g, i, rng.randint(1, 30)) for g in "ab" for i in range(150)]
    df = spark.createDataFrame(data, "g string, id int, size int")
    existing = spark.createDataFrame([("a", "000004.tar", 60), ("a", "000003.tar", 99), ("a", "x.tar", 1),
                                      ("b", "000007.tar", 120)], "g string, shard_file string, length bigint")
    opened = sharding.open_shard(existing, ["g"], 100)
    got = {(r.g, r.id): r.shard for r in sharding.assign_by_bytes(df, ["g"], ["id"], "size", 100, opened).collect()}
    for g, first, held in (("a", 4, 60), ("b", 8, None)):
        mine = [(i, s) for gg, i, s in data if gg == g]
        assert [got[(g, i)] for i, _ in mine] == _pack([s for _, s in mine], 100, first, held)


@pytest.mark.parametrize("seed", [1, 2])
def test_size_or_time_equals_loop(spark, seed):
    rng = random.Random(seed)
    at, data = 0, []
    for i in range(500):
        at += rng.choice([1, 1, 2, 60])
        data.append((i, at))
    df = spark.createDataFrame(data, "id int, at int").select("id", F.timestamp_seconds("at").alias("arrived_at"))
    got = {r.id: r.batch_no for r in batching.size_or_time_batches(df, "arrived_at", "id", 7, 100).collect()}
    want, batch, first, held = {}, -1, None, 0
    for i, at in data:
        if first is None or held >= 7 or at - first >= 100:
            batch, first, held = batch + 1, at, 0
        held += 1
        want[i] = batch
    assert got == want


def test_running_totals_and_row_numbers(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), i, rng.randint(0, 9)) for i in range(600)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    got = ordered.with_running_totals(df, ["g"], ["id"], {"before": "v"}).toPandas()
    got["g"] = got["g"].fillna("-")
    for _, group in got.groupby("g"):
        group = group.sort_values("id")
        assert (group["before"] == group["v"].cumsum() - group["v"]).all()
    numbered = ordered.with_row_number(df, [], [F.col("v").desc(), "id"], "n").toPandas().sort_values("n")
    assert list(numbered["n"]) == list(range(1, 601))
    assert numbered.equals(numbered.sort_values(["v", "id"], ascending=[False, True]))


def test_row_number_with_hash_chunks(spark):
    df = spark.range(500).select("id", (F.col("id") * 7919 % 1000).alias("h"))
    got = ordered.with_row_number(df, [], ["h", "id"], "n", F.floor(F.col("h") / 100)).toPandas()
    want = got.sort_values(["h", "id"]).reset_index(drop=True)
    assert list(want["n"]) == list(range(1, 501))


def test_first_per_key_orders_nulls_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", 3, 3), ("b", 9, 4)], "k string, o int, v int")
    assert rows(ordered.first_per_key(df, ["k"], [F.col("o")], last=True), "k", "v") == [("a", 2), ("b", 4)]
    assert rows(ordered.first_per_key(df, ["k"], [F.col("o")]), "k", "v") == [("a", 1), ("b", 3)]


def test_collate_and_rotating(spark):
    df = spark.range(26)
    got = batching.collate(df, ["id"], 12).toPandas().sort_values("id")
    assert list(got["batch_no"]) == [i // 12 for i in range(26)]
    turn = batching.rotating_batches(df, ["id"], [3, 5], min_size=3).toPandas().sort_values("id")
    want = [0] * 3 + [1] * 5 + [2] * 3 + [3] * 5 + [4] * 3 + [5] * 5
    assert list(turn["batch_no"])[:24] == want
    assert turn["batch_no"].isna().sum() == 2


def test_shard_by_count_width_and_start(spark):
    df = spark.createDataFrame([("m", i) for i in range(25)], "g string, id int")
    first = spark.createDataFrame([("m", 999998)], "g string, next_segment bigint")
    got = sharding.assign_by_count(df, ["g"], ["id"], 10, first).toPandas().sort_values("id")
    assert list(got["shard_file"])[0] == "0999998.tar"
    assert list(got["shard_file"])[-1] == "1000000.tar"
    plain = sharding.assign_by_count(df, ["g"], ["id"], 10).toPandas().sort_values("id")
    assert sorted(plain["shard_file"].unique()) == ["000000.tar", "000001.tar", "000002.tar"]
    assert plain.groupby("shard").size().max() == 10


def test_same_shards_whatever_the_partitioning(spark):
    data = [("g", i, (i * 37) % 11) for i in range(300)]
    df = spark.createDataFrame(data, "g string, id int, size int")
    one = sharding.assign_by_bytes(df.coalesce(1), ["g"], ["id"], "size", 40).toPandas()
    many = sharding.assign_by_bytes(df.repartition(13), ["g"], ["id"], "size", 40).toPandas()
    pd.testing.assert_frame_equal(one.sort_values("id").reset_index(drop=True), many.sort_values("id").reset_index(drop=True))


@pytest.mark.parametrize("cap", [1, 9, 60, 10_000])
def test_segments_up_and_down_a_tree(spark, monkeypatch, cap):
    """Many chunks, put together two at a time, with light, heavy and over-long segments."""
    monkeypatch.setattr(ordered, "FAN", 2)
    rng = random.Random(cap)
    data = [("hot" if i % 4 else f"g{i % 5}", i, rng.choice([0, 1, 2, 11])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, id int, size int").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        opened = spark.createDataFrame([("hot", 7, 3.0), ("g1", 2, None)], "g string, next_segment bigint, filled double")
        got = {(r.g, r.id): r.segment for r in ordered.greedy_segments(df, ["g"], ["id"], "size", cap, opened=opened).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want, state = {}, {"hot": [7, 3], "g1": [2, None]}
    for g, i, size in data:
        own = state.setdefault(g, [0, None])
        if own[1] is None:
            own[1] = size
        elif own[1] + size > cap:
            own[:] = [own[0] + 1, size]
        else:
            own[1] += size
        want[g, i] = own[0]
    assert got == want


def test_a_chunk_is_reduced_to_its_breakpoints():
    """Equal outcomes are one run: once the ways through a chunk meet, a few numbers stand for all its rows."""
    n = 1000
    weight = np.where(np.arange(n) % 10 == 9, 50.0, 1.0)
    upto = np.cumsum(weight)
    long = ordered._Passage(float(upto[-1]), 0.0, False, upto[:60], np.zeros(60), np.full(60, 16), np.full(60, 3.0), np.zeros(60))
    assert len(long.reduced().count) == 1
    assert long.reduced().leave(60, np.inf, 4, 10.0, 0.0, False) == long.leave(60, np.inf, 4, 10.0, 0.0, False) == (20, 3.0, 0.0, False)


def test_chunks_of_segments_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 60)
    cuts, whole = [], ordered.chunked

    def cut(*args):
        cuts.append(whole(*args))
        return cuts[-1]

    monkeypatch.setattr(ordered, "chunked", cut)
    df = spark.range(1200).select("id", F.lit(1).alias("size"))
    got = {r.id: r.segment for r in ordered.greedy_segments(df, [], ["id"], "size", 7).collect()}
    assert got == {i: i // 7 for i in range(1200)}
    sizes = [r["count"] for r in cuts[0].groupBy("__chunk").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 120
