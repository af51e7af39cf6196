"""SimHash against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lamella.llm import simhash


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance=3):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints_equal_definition(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "One", "ÉTÉ two", "a b c", "A  b\x0bC d", "x" * 5000, "w " * 70000]
    texts += [" ".join(rng.choice(["ab", "Cd", "é", "ÀB", " ", "x　y"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rows = [(i, t, "extra") for i, t in enumerate(texts)]
    got = {r.doc_id: r.fp for r in simhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()}
    assert {i: v % 2**64 for i, v in got.items()} == {i: slow_fingerprint(t) for i, t, _ in rows}
    assert spark.sql("select xxhash64('a b c') h").first().h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def clusters(seed, sizes, spread):
    rng, out = random.Random(seed), set()
    for size in sizes:
        centre = rng.getrandbits(64)
        while size:
            value = centre
            for _ in range(rng.randint(0, spread)):
                value ^= 1 << rng.randrange(64)
            size -= 1
            out.add(value)
            if rng.random() < 0.3:
                centre = value
    return sorted(out)


@pytest.mark.parametrize("crowd", [32, 4, 1])
def test_components_equal_all_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    values = clusters(crowd, [120, 40, 9, 3] + [1] * 100, 4)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.close_links(fps)).collect()}
    root = brute_components(values)
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(r, []).append(signed[i])
    want = {v: min(g) for g in groups.values() if len(g) > 1 for v in g if v != min(g)}
    assert got == want


def test_long_chain_is_one_component(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in simhash.components(links).collect()} == {0}


def test_rows_and_stage(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until night falls"
    rows = [(5, base, "a"), (3, base, "b"), (9, base.upper(), None), (7, None, "c"), (4, "", "c"), (None, base, "d"),
            (8, "something else entirely with other words", None), (8, "something else entirely with other words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (7, 4), (4, 4), (None, 3), (8, 8), (8, 8)], key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 4, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
