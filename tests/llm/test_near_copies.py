"""Near copies against brute force over all pairs of five-word sets."""

import random

import numpy as np
import pytest

import corpus_pipeline
from lamella.llm import near_copies, simhash


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def five(text):
    parts = text.split()
    return {tuple(parts[i:i + 5]) for i in range(max(len(parts) - 4, 1))}


def jaccard(a, b):
    return len(five(a) & five(b)) / len(five(a) | five(b))


def planted(seed, families, copies, changed):
    rng, out = random.Random(seed), []
    for _ in range(families):
        base = words(rng, 200)
        for _ in range(copies):
            own = list(base)
            for at in rng.sample(range(200), rng.randint(0, changed)):
                own[at] = words(rng, 1)[0]
            out.append(" ".join(own))
    rng.shuffle(out)
    return out + [" ".join(words(rng, 120)) for _ in range(30)]


def brute_kept(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8 or bin(simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j])).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [i for i in range(len(texts)) if find(i) == i]


def as_docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_stage_removes_planted_near_copies(spark):
    texts = planted(4, 25, 3, 4)
    near = [(a, b) for i, a in enumerate(texts) for b in texts[:i] if a != b and jaccard(a, b) >= 0.8]
    far = [1 for a, b in near if bin(simhash.fingerprint(a) ^ simhash.fingerprint(b)).count("1") > 3]
    assert len(far) > 10
    kept = corpus_pipeline.near_duplicates(spark, as_docs(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(texts)


@pytest.mark.parametrize("crowd", [1, 4])
def test_crowded_keys_lose_no_pair(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    texts = planted(crowd, 3, 25, 9)
    kept = near_copies.keep_one(as_docs(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(texts)


ROWS = [(1, "alpha beta gamma delta epsilon zeta eta theta", "a"), (1, "one two three four five six seven eight", "b"), (None, "alpha beta gamma delta epsilon zeta eta theta", "c"),
        (None, "alpha beta gamma delta epsilon zeta eta theta", "c"), (7, "one two three four five six seven eight", "d"), (None, None, "e"), (3, "", "f"), (3, "", "f"),
        (4, " \t\n", "g"), (None, "nothing like any of the other texts here at all", "h"), (None, "nothing like any of the other texts here at all", "h"),
        (9, "w " * 60_000 + "end", "i"), (8, "w " * 60_000 + "end", "j"), (5, "short", "k"), (6, "short", "l")]
KEPT = [(1, "a"), (1, "b"), (3, "f"), (5, "k"), (8, "j"), (None, "h")]


@pytest.mark.parametrize("keep", [near_copies.keep_one, simhash.keep_one])
def test_one_row_of_each_group_stays(spark, keep):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in ROWS], "doc_id bigint, text string, tag string, _kept int, _score string, row_id int")
    kept = keep(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.tag) for r in kept.collect()), key=repr) == sorted(KEPT, key=repr)
    assert {r.doc_id: r.text for r in kept.collect() if r.tag in "ab"} and {r.text for r in kept.collect() if r.doc_id == 1} == {ROWS[0][1], ROWS[1][1]}
    assert keep(docs.limit(0)).count() == 0


def test_pairs_grow_with_a_group_of_copies_and_not_its_square(spark, monkeypatch):
    counts = {}
    for copies in (60, 240):
        texts, seen = planted(9, 1, copies, 3), []
        own = near_copies.verified
        monkeypatch.setattr(near_copies, "verified", lambda pairs, sets: seen.append(pairs.distinct().count()) or own(pairs, sets))
        assert near_copies.keep_one(as_docs(spark, texts)).count() == 31
        monkeypatch.undo()
        counts[copies] = sum(seen)
    assert counts[240] < 8 * counts[60]


def test_signatures_count_agreeing_minima(spark):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 40, 300)]
    sets += [np.unique(np.concatenate([s, rng.integers(0, 1 << 63, max(len(s) // 5, 1), dtype=np.uint64)])) for s in sets]
    marks = [near_copies.node_and_keys(s)[2] for s in sets]
    rows = [(i, j, a.view(np.int64).tolist(), b.view(np.int64).tolist()) for i, a in enumerate(marks) for j, b in enumerate(marks)]
    frame = spark.createDataFrame(rows, "i int, j int, a array<bigint>, b array<bigint>")
    got = {(r.i, r.j): r.n for r in frame.select("i", "j", near_copies.agreeing("a", "b").alias("n")).collect()}
    lanes = [np.stack([m >> np.uint64(8 * i) & np.uint64(0x7F) for i in range(7)], axis=1).ravel()[:120] for m in marks]
    assert got == {(i, j): int((x == y).sum()) for i, x in enumerate(lanes) for j, y in enumerate(lanes)}
    assert all(got[i, i] == 120 for i in range(len(sets))) and got[0, 1] < 20
