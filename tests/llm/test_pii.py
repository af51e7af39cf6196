"""Anchor expansion against the regular expressions it must agree with."""

import hashlib
import random
import re
import time

import pytest

from lamella.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


PARTS = ["a", "B.", "@", "@@", ".", "..", "1", "25", "255", "256", "0001", " ", "-", "+", "+1", "(", ")", "é", "١", "\n", "x@y.z", "10.0.0.1",
         "4111 1111 1111 1111", "4111111111111111", "+1 (555) 010-9999", "a%b@c-d.e", "://", "IBAN", "_", "%"]


@pytest.mark.parametrize("seed", range(4))
def test_base_equals_expressions(seed):
    rng, anchors = random.Random(seed), pii.automaton()
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        got = [s for s in pii.find(text, anchors) if s[1] < 4]
        assert got == brute(text), repr(text)


@pytest.mark.parametrize("tail", ["", "@", "@b.co"])
@pytest.mark.parametrize("unit", ["1.", "1", "a@", "+1 ", "1 ", "a.", "a.b@c.d "])
def test_long_texts_equal_expressions_in_linear_time(unit, tail):
    anchors = pii.automaton()
    short = unit * 400 + tail
    assert [s for s in pii.find(short, anchors) if s[1] < 4] == brute(short)
    start = time.process_time()
    pii.find(unit * 200_000 + tail, anchors)
    assert time.process_time() - start < 20  # quadratic work would take hours


def test_accounts():
    anchors = pii.automaton()
    text = "IBAN: DE89 3704 0044 0532 0130 00, bad IBAN DE88 3704 0044 0532 0130 00, http://me:secret@host/x"
    found = [text[a:b] for a, k, b in pii.find(text, anchors) if pii.KINDS[k] == "account"]
    assert found == ["DE89 3704 0044 0532 0130 00", "me:secret"]


def test_rows_and_mask(spark):
    rows = [(1, "mail é a@b.co now", "x"), (None, None, "y"), (2, "", None), (2, "", None), (3, "no data here", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.find_spans(docs)
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got.collect()), key=repr) == sorted(
        [(1, [("email", 7, 13)]), (None, []), (2, []), (2, []), (3, [])], key=repr)
    hidden = pii.mask(docs)
    assert hidden.schema == docs.schema
    assert {r.text for r in hidden.collect()} == {"mail é [EMAIL] now", None, "", "no data here"}
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_registered_query(spark):
    """Counts, digest and list of spans of op6 from brute force over the texts."""
    from lamella.llm.queries import QUERIES

    folder, kinds = "/root/testdata/sf0.001", ("email", "ip", "card", "phone")
    got = {r.doc_id: r for r in QUERIES["op6_pii_anchors"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        base, row = brute(text or ""), got[doc_id]
        assert [row[f"n_{k}"] for k in kinds] == [sum(s[1] == i for s in base) for i in range(4)]
        listed = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(base, key=lambda s: (s[0], s[1])))
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert {x for x in listed.split(",") if x} <= set(row.spans.split(","))
