"""Collision counting against brute force."""

import numpy as np
from pyspark.sql import functions as F

from lamella.llm import collision_ann

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def brute(rows, k=20):
    good = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good.get(i, v), v)
    out = {}
    for q, v in good.items():
        if q % 20 == 0:
            scored = sorted((-float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), i)
                            for i, w in good.items() if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(spark, rows, **kw):
    out = {}
    for r in collision_ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, **kw).collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for ranks in out.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
    return {q: [ranks[i] for i in sorted(ranks)] for q, ranks in out.items()}


def recall(got, want):
    hits = [len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items() if w]
    return float(np.mean(hits))


def test_recall_over_blocks_and_norms(spark, monkeypatch):
    monkeypatch.setattr(collision_ann, "BLOCK", 500)
    monkeypatch.setattr(collision_ann, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 32))
    vectors = centres[rng.integers(0, 12, 2500)] + rng.normal(size=(2500, 32))
    for scale in (np.ones(2500), rng.uniform(0.2, 3, 2500)):
        own = vectors / np.linalg.norm(vectors, axis=1)[:, None] * scale[:, None]
        own[1000:1300] = own[1000] * (1 + 1e-4 * rng.normal(size=(300, 1)))
        rows = [(i, [float(np.float32(x)) for x in v], "x") for i, v in enumerate(own)]
        got, want = found(spark, rows), brute(rows)
        assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
        assert recall(got, want) >= 0.95
        exact = {i: v for i, v, _ in rows}
        for q, near in got.items():
            assert near == sorted(near, key=lambda x: (-x[1], x[0]))
            for i, score in near:
                assert abs(score - float(np.dot(exact[q], exact[i]))) < 1e-12


def test_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 1.0], None), (2, [1.0, 1.0], "t"), (3, [0.0, 0.0], "z"), (4, None, "n"), (5, [nan, 1.0], "n"),
            (6, [1.0, None], "n"), (7, [inf, 1.0], "n"), (None, [1.0, 1.0], "n"), (20, [-1.0, 0.0], "q"), (40, [1.0, 2.0, 3.0], "other"),
            (1, [1.0, 1.0], "again"), (60, [], "empty")]
    assert found(spark, rows) == {0: [(1, 1.0), (2, 1.0), (20, -1.0)], 20: [(0, -1.0), (1, -1.0), (2, -1.0)]}
    assert found(spark, rows, k=1) == {0: [(1, 1.0)], 20: [(0, -1.0)]}
    assert found(spark, []) == {}
