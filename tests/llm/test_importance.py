"""Prefix CRCs against plain ones, and the draw against a loop."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lamella.llm import importance


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def runs_of(words, longest):
    return [" ".join(words[i:i + n]).encode() for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


TEXTS = ["", None, "One  two, THREE-four.", "ÀÉ é 中文 x_y 0189 a\x00b\x7fc", "z" * 70_000 + " tail", "--- ... ", "a"]


@pytest.mark.parametrize("longest", [1, 2, 5])
def test_runs_from_prefixes(longest):
    rng = random.Random(longest)
    texts = TEXTS + ["".join(rng.choice("ab CD.é1\n") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    found = importance.run_crcs([importance.plain_words(t) for t in texts], importance.zero_tables(), longest)
    assert len(found) == len(texts)
    for text, own in zip(texts, found):
        assert own.tolist() == [zlib.crc32(run) for run in runs_of(words_of(text), longest)]


def test_shift_appends_zero_bytes():
    rng = np.random.default_rng(1)
    crc, length = rng.integers(0, 1 << 32, 200, dtype=np.uint32), rng.integers(0, 5000, 200)
    table = importance.zero_tables()[0][0]
    for value, n, own in zip(crc.tolist(), length.tolist(), importance.shifted(importance.zero_tables(), crc, length).tolist()):
        for _ in range(n):
            value = int(table[value & 255]) ^ value >> 8
        assert own == value
    assert importance.run_crcs([], importance.zero_tables()) == []


def brute(docs, target, longest=1, buckets=10_000, percent=10):
    held = [[zlib.crc32(r) % buckets for r in runs_of(words_of(t), longest)] for _, t in docs]
    raw, aim = Counter(b for own in held for b in own), Counter(zlib.crc32(r) % buckets for t in target for r in runs_of(words_of(t), longest))
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets))))
    rows = []
    for (doc_id, text), own in zip(docs, held):
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, own))
        rows.append([doc_id, len(words_of(text)), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    enough = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -math.inf if r[0] is None else r[0], r[3], r[2]))
    drawn = percent * len(enough) // 100
    for place, row in enumerate(enough, 1):
        row.append(place if place <= drawn else None)
    return sorted((tuple(r) if len(r) == 6 else (*r, None) for r in rows), key=repr)


def resampled(spark, docs, target, **how):
    found = importance.resample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(t,) for t in target], "text string"), **how)
    return sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"longest": 3, "buckets": 70_000, "percent": 40}])
def test_draw_equals_loop(spark, how):
    rng = random.Random(13)
    line = lambda n: " ".join(rng.choice(["Red", "green", "blue", "x1", "é"]) + rng.choice(["", ",", "y"]) for _ in range(n))
    docs = [(i, line(rng.choice([5, 19, 20, 60]))) for i in range(300)] + [(300 + i, "all the same words " * 6) for i in range(20)]
    target = [line(30) for _ in range(5)]
    assert resampled(spark, docs, target, **how) == brute(docs, target, **how)


def test_defined_cases(spark):
    docs = [(None, None), (None, "word " * 30), (1, ""), (2, "w " * 25), (2, "w " * 25), (2, "v " * 26), (3, "a" * 100_000), (4, "b " * 50_000)]
    for target in (["w v"], [None, ""], []):
        assert resampled(spark, docs, target, percent=60) == brute(docs, target, percent=60)
    assert resampled(spark, [], ["w"]) == []
    clash = spark.createDataFrame([(1, "x " * 30, "n", 5)], "doc_id bigint, text string, held string, rank int")
    assert importance.resample(clash, clash.select("text", "rank")).columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def test_registered_query(spark):
    from lamella.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    found = QUERIES["op13_prefix_crc"](spark, folder)
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("text").collect()]
    want = sorted(((r[0], *r[2:]) for r in brute(docs, target)), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert dict(found.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
