"""The audit against one that applies every order to every document."""

import random
from itertools import permutations

import pytest

from lamella.llm import filter_audit
from lamella.llm.filter_audit import FILTERS, lehmer_rank, removal_intervals

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_intervals_cover_every_order_once():
    orders = ["".join(p) for p in permutations(FILTERS)]
    assert [lehmer_rank(o) for o in orders] == list(range(120))
    for mask in range(32):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        found = {}
        for step, last, start, stop in removal_intervals(mask):
            for rank in range(start, stop):
                assert rank not in found
                found[rank] = step, last
        want = {r: next((i + 1, f) for i, f in enumerate(o) if f in fails) for r, o in enumerate(orders) if fails}
        assert found == want


def _fails(text, first):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return {f for f, bad in zip(FILTERS, (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        any(c in "#$%&*|" for c in text), not first)) if bad}


def brute(docs, labels):
    """Rows of the audit; ``docs`` are (doc_id, source, text), ``labels`` (doc_id, quality, toxic)."""
    rows = []
    for doc_id, source, text in docs:
        body = text or ""
        earlier = doc_id is not None and any(i is not None and i < doc_id and (t or "") == body for i, _, t in docs)
        own = [(q, x) for i, q, x in labels if i == doc_id and i is not None]
        rows.append((source or "", _fails(body, not earlier), any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    out = []
    for part in {r[0] for r in rows}:
        here, shares = [r for r in rows if r[0] == part], dict.fromkeys(FILTERS, 0)
        found = []
        for order in permutations(FILTERS):
            left = here
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shares[f] += len(gone)
                found.append((part, "".join(order), step, len(left), len(gone), sum(f in r[1] for r in here) - len(gone),
                              sum(r[1] == {f} for r in here), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*r[:-1], shares[r[-1]]) for r in found]
    return sorted(out)


def audited(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    result = filter_audit.audit(frame, known)
    assert result.columns == COLUMNS
    return sorted(tuple(r) for r in result.collect())


def test_audit_equals_every_order_applied(spark):
    rng = random.Random(11)
    pool = [" ".join(rng.choice(["w%d" % rng.randrange(90), "Loud", "SHOUT", "a#b", "x\ty"][:rng.randint(1, 5)]) for _ in range(rng.choice([3, 49, 50, 80])))
            for _ in range(25)]
    docs = [(i, rng.choice(["a", "b", None, ""]), rng.choice(pool)) for i in range(120)]
    labels = [(rng.randrange(140), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(90)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    docs = [(None, "a", "same"), (None, "a", "same"), (3, "a", "same"), (3, "a", "same"), (4, "b", "same"), (5, None, None), (6, None, ""),
            (7, "", "  \n"), (8, "a", long), (-1, "b", long), (9, "b", " ".join(["x"] * 60)), (10, "b", "É" * 60)]
    labels = [(None, 1, 1), (3, 1, 0), (3, None, 1), (8, 0, 1), (99, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)
    assert audited(spark, docs, []) == brute(docs, [])
    assert audited(spark, [], labels) == []


def test_hot_text_and_clashing_columns(spark):
    docs = [(i, f"s{i % 3}", "copied text") for i in range(3000)] + [(None, "s0", f"t{i}") for i in range(1500)]
    frame = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id bigint, source string, text string, mask int, n int, k1 int")
    result = filter_audit.audit(frame, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    first = {(r.part, r.step): r for r in result.filter("filter_order = 'EABCD'").collect()}
    assert [first[p, 1].removed for p in ("s0", "s1", "s2")] == [999, 1000, 1000]
    assert first["s0", 2].removed == 1501 and first["s0", 2].redundant == 999 and first["s0", 5].kept == 0


def test_registered_query(spark):
    from lamella.llm.queries import QUERIES

    result = QUERIES["op11_filter_audit"](spark, "/root/testdata/sf0.001")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert result.columns == COLUMNS and sorted(tuple(r) for r in result.collect()) == brute(docs, labels)
    assert dict(result.dtypes) == {c: "string" if c in ("part", "filter_order") else "int" if c == "step" else "bigint" for c in COLUMNS}


@pytest.mark.parametrize("part", ["lang", "source"])
def test_any_part(spark, part):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    result = filter_audit.audit(docs, labels, part=part).filter("step = 5 AND filter_order = 'ABCDE'")
    kept = {r.part: r.kept for r in result.collect()}
    assert kept.keys() == {r[0] or "" for r in docs.select(part).distinct().collect()}
