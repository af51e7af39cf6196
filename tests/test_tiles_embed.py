import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lamella.operators import embed, tiles
from tests.conftest import rows


def test_grid(spark):
    slides = spark.createDataFrame([("a", 130, 64, 0.5), ("b", 130, 64, 0.25), ("c", 10, 10, 0.5), ("d", 64, 64, None)],
                                   "slide_id string, width int, height int, native_mpp double")
    got = rows(tiles.tile_grid(slides, 64))
    assert got == [("a", 0, 0, 64), ("a", 64, 0, 64), ("d", 0, 0, 64)]
    assert len(rows(tiles.tile_grid(slides.where("slide_id = 'a'"), 64, overlap=32))) == 3
    assert rows(tiles.tile_grid(slides.where("slide_id = 'b'"), 32)) == [("b", 0, 0, 64), ("b", 64, 0, 64)]


@pytest.fixture(scope="module")
def scene(spark):
    """Random tiles and rectangles on two slides, one of them carrying most of both."""
    rng = random.Random(3)
    t = [("big" if i % 5 else "small", i, rng.randint(0, 900), rng.randint(0, 900), rng.choice([32, 64, 100])) for i in range(120)]
    m = []
    for s in ("big", "small"):
        for gx in range(0, 1000, 250):
            for gy in range(0, 1000, 125):
                m.append((s, gx, gx + rng.randint(50, 250), gy, gy + rng.randint(20, 125), rng.randint(0, 7)))
    return (spark.createDataFrame(t, "slide_id string, tile_idx int, x bigint, y bigint, side bigint"),
            spark.createDataFrame(m, "slide_id string, x0 int, x1 int, y0 int, y1 int, class int"), t, m)


@pytest.mark.parametrize("block", [37, 128, 5000])
def test_centre_class_equals_loop(scene, block):
    t, m, raw_t, raw_m = scene
    want = sorted((s, i, c) for s, i, x, y, side in raw_t for ms, x0, x1, y0, y1, c in raw_m
                  if ms == s and x0 <= x + side // 2 < x1 and y0 <= y + side // 2 < y1)
    assert sorted(tuple(r) for r in tiles.tile_class(t, m, block).select("slide_id", "tile_idx", "class").collect()) == want


@pytest.mark.parametrize("block", [37, 128, 5000])
def test_shares_equal_loop(scene, block):
    t, m, raw_t, raw_m = scene
    want = {}
    for s, _, x, y, side in set((s, 0, x, y, side) for s, _, x, y, side in raw_t):
        for ms, x0, x1, y0, y1, c in raw_m:
            area = max(0, min(x + side, x1) - max(x, x0)) * max(0, min(y + side, y1) - max(y, y0))
            if ms == s and area:
                want[s, x, y, side, c] = want.get((s, x, y, side, c), 0) + area / side**2
    got = {tuple(r)[:5]: r.share for r in tiles.class_shares(t.drop("tile_idx").distinct(), m, block).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("patch,overlap", [(32, 0), (40, 15), (300, 100)])
def test_grid_forms_equal_tile_forms_and_shuffle_no_tile(spark, monkeypatch, scene, patch, overlap):
    _, m, _, _ = scene
    monkeypatch.setattr(tiles, "GRID_BLOCK", 3)
    slides = spark.createDataFrame([("big", 1000, 930, 0.5), ("small", 700, 1000, 0.3), ("none", 900, 900, 0.5), ("thin", 5, 900, 0.5)],
                                   "slide_id string, width int, height int, native_mpp double")
    geometry, grid = tiles.grid_geometry(slides, patch, 0.5, overlap), tiles.tile_grid(slides, patch, 0.5, overlap)
    assert rows(tiles.grid_class(geometry, m)) == rows(tiles.tile_class(grid, m, 128))
    want = {tuple(r)[:5]: r.share for r in tiles.class_shares(grid, m, 128).collect()}
    got = {tuple(r)[:5]: r.share for r in tiles.grid_class_shares(geometry, m).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    tissue = {tuple(r)[:3]: r.tissue_share for r in tiles.grid_min_tissue(geometry, m, [1, 2], 0.2).collect()}
    assert tissue == pytest.approx({tuple(r)[:3]: r.tissue_share for r in tiles.min_tissue(tiles.class_shares(grid, m, 128), [1, 2], 0.2).collect()})
    for frame in (tiles.grid_class(geometry, m), tiles.grid_class_shares(geometry, m), tiles.grid_min_tissue(geometry, m, [1], 0.1)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        last = min(i for i, line in enumerate(plan.splitlines()) if "Exchange" in line)
        # Lines above the topmost exchange run after it: the tiles are made there.
        assert any("Generate explode(CASE WHEN" in line or "Generate explode(sequence" in line for line in plan.splitlines()[:last])


def test_grid_cover_keeps_no_shares_in_lists(spark, scene):
    """Tiles are measured by arithmetic: no list of shares or classes is built per tile, and only long lists of rectangles are folded."""
    _, m, _, _ = scene
    geometry = tiles.grid_geometry(spark.createDataFrame([("big", 1000, 930, 0.5)], "slide_id string, width int, height int, native_mpp double"), 32, 0.5, 0)
    for frame in (tiles.grid_class_shares(geometry, m), tiles.grid_min_tissue(geometry, m, [1], 0.1)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert not any(word in plan for word in ("transform(", "filter(", "exists(", "array_distinct("))


def test_artifact_fallback(spark):
    data = [("lost", i, 4 if i < 19 else 1) for i in range(20)] + [("fine", i, 4 if i < 17 else 1) for i in range(20)] + [("edge", i, 4 if i < 18 else 1) for i in range(20)]
    df = spark.createDataFrame(data, "slide_id string, tile_idx int, class int")
    counts = dict(rows(tiles.remove_artifacts(df, [4, 7]).groupBy("slide_id").count()))
    assert counts == {"lost": 20, "fine": 3, "edge": 2}
    assert tiles.remove_artifacts(df, []).count() == 60


@pytest.mark.parametrize("excluded,max_loss", [([4, 7], 0.9), ([0, 1, 2, 3], 0.3), ([1, 2], 0.1), ([], 0.9)])
def test_grid_without_artifacts_makes_tiles_last(spark, scene, excluded, max_loss):
    _, m, _, _ = scene
    m = m.unionByName(spark.createDataFrame([("small", 0, 400, 0, 90, None)], m.schema))
    geometry = tiles.grid_geometry(spark.createDataFrame([("big", 1000, 930, 0.5), ("small", 700, 1000, 0.3), ("none", 90, 90, 0.5)],
                                                         "slide_id string, width int, height int, native_mpp double"), 32, 0.5, 8)
    frame = tiles.grid_without_artifacts(geometry, m, excluded, max_loss)
    assert rows(frame) == rows(tiles.remove_artifacts(tiles.grid_class(geometry, m), excluded, max_loss))
    plan = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert max(i for i, line in enumerate(plan) if "Generate explode" in line) < min(i for i, line in enumerate(plan) if "Join" in line)


def test_annotation_mapping(spark):
    df = spark.createDataFrame([(0,), (1,), (4,), (9,)], "class int")
    assert rows(tiles.annotate(df, {0: 5, 1: 1, 4: 0}), "class", "annotation") == [(1, 1), (4, 0)]
    assert rows(tiles.annotate(df), "annotation") == [(1,), (4,), (9,)]


def test_annotated_features(spark, scene):
    t, m, *_ = scene
    features = t.select("slide_id", "tile_idx", F.array(F.lit(1.0)).alias("features"))
    some = tiles.annotated_features(features, t, m, 128)
    strict = tiles.annotated_features(features, t, m, 128, min_share=0.9)
    assert 0 < strict.count() < some.count()
    assert strict.join(some, ["slide_id", "tile_idx", "annotation"], "left_anti").count() == 0
    assert tiles.stack([some, some]).count() == some.count()


@pytest.fixture(scope="module")
def bags(spark):
    sizes = {("A", 1): 50, ("A", 2): 3, ("A", 3): 20, ("B", 4): 5, ("B", 5): 4}
    data = [(sample, slide, t) for (sample, slide), n in sizes.items() for t in range(n)]
    return spark.createDataFrame(data, "sample_id string, slide_id bigint, tile_idx bigint")


def _sizes(df):
    return {(r.sample_id, r.slide_id): r["count"] for r in df.groupBy("sample_id", "slide_id").count().collect()}


def _key():
    return tiles.tile_order(F.col("slide_id"), F.col("tile_idx"))


def test_budgets(bags):
    assert tiles.subsample(bags, _key(), None).count() == 82
    drawn = tiles.subsample(bags, _key(), 20, "random")
    assert dict(rows(drawn.groupBy("sample_id").count())) == {"A": 20, "B": 9}
    assert _sizes(tiles.subsample(bags, _key(), 20, "proportional")) == {("A", 1): 14, ("A", 2): 1, ("A", 3): 5, ("B", 4): 5, ("B", 5): 4}
    assert _sizes(tiles.subsample(bags, _key(), 20, "equal")) == {("A", 2): 3, ("A", 3): 9, ("A", 1): 8, ("B", 4): 5, ("B", 5): 4}
    assert _sizes(tiles.subsample(bags, _key(), 1000, "equal")) == _sizes(bags)
    with pytest.raises(ValueError):
        tiles.subsample(bags, _key(), 5, "other")


def test_budget_draw_is_stable(bags):
    one = rows(tiles.subsample(bags.repartition(7), _key(), 20, "random"))
    assert one == rows(tiles.subsample(bags.coalesce(1), _key(), 20, "random"))
    assert one != rows(tiles.subsample(bags, tiles.tile_order(F.col("slide_id"), F.col("tile_idx"), 7), 20, "random"))


def test_cap_and_merge(spark, bags):
    capped = tiles.cap_per_slide(bags, _key(), 10)
    assert max(_sizes(capped).values()) == 10 and capped.count() == 32
    slides = spark.createDataFrame([("A", 1, "LUAD"), ("A", 2, "BRCA"), ("A", 3, None), ("B", 4, None), ("B", 5, "X")], "sample_id string, slide_id bigint, oncotree_code string")
    features = bags.select("slide_id", "tile_idx", F.array(F.lit(0.0)).alias("features"))
    merged = tiles.merge_samples(features, slides, _key(), 20, "equal")
    got = merged.toPandas()
    assert sorted(got[got.sample_id == "A"].tile_idx) == list(range(20))
    assert set(got[got.sample_id == "A"].oncotree_code) == {"LUAD"} and got[got.sample_id == "B"].oncotree_code.isna().all()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    data = [(i, i % 3, f"c{i % 2}", [float(v) for v in (rng.normal(size=6) + np.eye(6)[i % 3] * 4).astype(np.float32)]) for i in range(90)]
    return spark.createDataFrame(data, "tile_idx int, label int, code string, features array<float>")


def test_pooling_equals_numpy(vectors):
    got = {r.label: r for r in embed.pool(vectors, ["label"]).collect()}
    frame = vectors.toPandas()
    for label, group in frame.groupby("label"):
        x = np.array(group.features.to_list(), dtype=float)
        np.testing.assert_allclose(got[label].mean_features, x.mean(0), atol=1e-9)
        np.testing.assert_allclose(got[label].max_features, x.max(0), atol=1e-9)
        assert got[label].n_tiles == len(x)


def _loop_best(frame, classes):
    out = {}
    for r in frame.itertuples():
        best = max(((np.dot(r.features, e) / np.linalg.norm(r.features) / np.linalg.norm(e), -ord(c[0]), c)
                    for key, c, e in classes if key is None or key == r.code), default=None)
        out[r.tile_idx] = best and (best[2], best[0])
    return out


@pytest.mark.parametrize("block,rows_at_once", [(4096, 65_536), (1, 7)])
def test_zero_shot_equals_loop(spark, vectors, block, rows_at_once):
    classes = [("c0", n, [float(v) for v in np.eye(6)[i]]) for i, n in enumerate("xyz")] + [("c1", "x", [0.0, 1.0, 1.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame(classes, "code string, class string, embedding array<double>")
    got = {r.tile_idx: (r["class"], r.similarity) for r in embed.zero_shot(vectors, table, "code", block=block, rows_at_once=rows_at_once).collect()}
    want = _loop_best(vectors.toPandas(), classes)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-6) for k in want)
    unknown = embed.zero_shot(vectors.withColumn("code", F.lit("none")), table, "code")
    assert unknown.where("class IS NOT NULL").count() == 0 and unknown.count() == 90


@pytest.mark.parametrize("block", [1, 4096])
@pytest.mark.parametrize("copies", [1, 1500])
def test_zero_shot_without_vector_or_code(spark, block, copies):
    """NULL codes and zero vectors are treated alike at any class count."""
    tiles = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, None, [1.0, 0.0]), (2, "a", [0.0, 0.0]), (3, "a", None), (4, "", [0.0, 1.0])],
                                  "tile_idx int, code string, features array<float>")
    table = [("a", f"k{i:04d}", [1.0, 0.0]) for i in range(copies)] + [("", "blank", [0.0, 1.0]), (None, "none", [1.0, 0.0]), ("a", "zero", [0.0, 0.0])]
    classes = spark.createDataFrame(table, "code string, class string, embedding array<double>")
    if block == 1 and copies > 1:
        block = 100
    got = {r.tile_idx: (r["class"], r.similarity) for r in embed.zero_shot(tiles, classes, "code", block=block).collect()}
    assert got == {0: ("k0000", 1.0), 1: (None, None), 2: (None, None), 3: (None, None), 4: ("blank", 1.0)}


def test_encode_classify_and_variants(vectors):
    weights = np.arange(12, dtype=float).reshape(6, 2)
    encoded = embed.encode(vectors.withColumnRenamed("features", "pixels"), embed.projection_encoder(weights), "proj", 6, batch_size=7).toPandas()
    np.testing.assert_allclose(np.array(encoded.features.to_list()), np.array(encoded.pixels.to_list(), dtype=float) @ weights, rtol=1e-4, atol=1e-3)
    train = vectors.withColumn("y", (F.col("label") == 0).cast("double")).withColumn("_vector", array_to_vector("features"))
    model = Pipeline(stages=[LogisticRegression(featuresCol="_vector", labelCol="y", maxIter=20)]).fit(train)
    scored = embed.classify(vectors, model)
    kept = tiles.score_filter(scored)
    assert 20 <= kept.count() <= 40 and kept.where("label = 0").count() > kept.count() * 0.8
    base = vectors.select("tile_idx", "features", F.lit("uni").alias("model"), F.lit("float32").alias("precision"))
    variants = embed.precision_variants(base, ["float16", "bfloat16", "float32"])
    assert sorted(r[0] for r in variants.select("model").distinct().collect()) == ["uni", "uni_bfloat16", "uni_float16"]
    assert variants.count() == 270
    index = embed.tile_index(vectors.select(F.col("code").alias("slide_id"), "tile_idx", F.col("label").alias("class")), [1])
    assert rows(index.select("tile_idx")) == sorted(((i,) for i in range(90) if i % 3 == 1), key=repr)


def test_probe_inputs_replace_slide_encoders(spark):
    features = spark.createDataFrame([("titan_slide", 1), ("uni", 2)], "model string, v int")
    patches = spark.createDataFrame([("conch1_5", 3), ("gigapath", 4), ("uni", 5)], "model string, v int")
    assert rows(embed.probe_inputs(features, patches)) == [("conch1_5", 3), ("uni", 2)]


def test_mapping_frame(spark):
    df = spark.createDataFrame([(0,), (1,), (4,), (9,)], "class int")
    pairs = spark.createDataFrame([(0, 5), (1, 1), (4, 0)], "raw int, mapped int")
    assert rows(tiles.annotate(df, pairs), "class", "annotation") == [(1, 1), (4, 0)]


def test_budgets_with_text_keys_keep_the_payload_out(spark):
    """Slide ids are any text; only keys are ranked, so nothing written holds a vector."""
    data = spark.range(400).select(F.concat(F.lit("TCGA-"), F.col("id") % 3).alias("slide_id"), F.lit("s").alias("sample_id"),
                                   F.col("id").cast("int").alias("tile_idx"), F.array(F.col("id").cast("float")).alias("features"))
    order = tiles.tile_order(F.col("slide_id"), F.col("tile_idx"))
    for budget in (tiles.cap_per_slide(data, order, 10), tiles.subsample(data, order, 30, "equal")):
        got = budget.collect()
        assert len(got) == 30 and all(r.features == [float(r.tile_idx)] for r in got)
    slides = data.select("slide_id", "sample_id", F.lit("C").alias("oncotree_code")).distinct()
    merged = tiles.merge_samples(data.drop("sample_id"), slides, order, 25)
    assert sorted(r.tile_idx for r in merged.collect()) == list(range(25))
    assert {len(r.features) for r in merged.collect()} == {1}
