"""Quotation linking against a recursive loop, and its SQL twin on the same rows."""

import random

import duckdb

from lamella.llm import quote_links
from lamella.llm.queries import ORACLES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, body string"
NAMES = ["conv_id", "turn", "role", "position", "depth", "reply_to", "n_quoted", "n_linked", "body"]


def run(spark, rows):
    got = quote_links.conversations(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((tuple(r) for r in got.select(*NAMES).collect()), key=repr)


def quoted(text, marks="> "):
    return "\n".join(marks + line for line in text.split("\n"))


def test_replies_and_bodies(spark):
    first, second = "Shall we meet on Monday?\nI have time.\n\nOr on Tuesday.", "Monday is fine."
    rows = [(1, 0, "a", first, "x"), (1, 1, "b", second, "x"),
            (1, 2, "c", f"On Sunday a wrote:\n{quoted('Or on  TUESDAY.')}\nTuesday please", "x"),
            (1, 3, "a", f"{quoted(second)}\n{quoted('Shall we meet on Monday? I have time.', '> > ')}\nGood.", "x"),
            (1, 4, "b", "> never said\nWhat?", "x"), (2, 0, "a", "> Monday is fine.\nalone", None)]
    assert run(spark, rows) == sorted([
        (1, 0, "a", 0, 0, None, 0, 0, first), (1, 1, "b", 1, 1, 0, 0, 0, second), (1, 3, "a", 2, 2, 1, 2, 2, "Good."),
        (1, 4, "b", 3, 3, 3, 1, 0, "What?"), (1, 2, "c", 4, 1, 0, 1, 1, "Tuesday please"), (2, 0, "a", 0, 0, None, 1, 0, "alone")], key=repr)


def sample(seed):
    rng, rows = random.Random(seed), []
    pool = ["the same words", "other words here", "On Monday x wrote:", "", "short", "  Spaced   OUT "]
    for conv in (1, 2, 3, 4, None):
        said = []
        for turn in range({1: 90, 2: 1}.get(conv, 12)):
            lines = [rng.choice(pool) if rng.random() < 0.5 else f"line {rng.randint(0, 40)} of it" for _ in range(rng.randint(0, 4))]
            if said and rng.random() < 0.6:
                source = rng.choice(said).split("\n")
                lines.insert(rng.randint(0, len(lines)), quoted("\n".join(rng.sample(source, rng.randint(1, len(source)))), rng.choice(["> ", ">", ">> "])))
            text = "\n".join(lines)
            said.append(text)
            rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), text if rng.random() < 0.95 else None, "extra"))
    return rows + rows[3:6]


def test_equals_sql(spark):
    rows = sample(4)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, body VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?)", rows)
    result = con.execute(ORACLES["op1_quote_links"])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r[names.index(n)] for n in NAMES) for r in result.fetchall()), key=repr)
    got = run(spark, rows)
    assert sum(r[7] for r in got) > 20
    assert sorted(got, key=repr) == want


def test_one_long_conversation_and_a_hot_parent(spark):
    rows = [(None, i, "u", f"message {i}", None) for i in range(150)]
    rows += [(7, 0, "u", "hub", None)] + [(7, i, "u", "> hub\nsame", None) for i in range(1, 150)]
    got = {(r[0], r[1]): (r[3], r[4], r[5]) for r in run(spark, rows)}
    assert all(got[None, i] == (i, i, i - 1 if i else None) for i in range(150))
    assert all(got[7, i] == (i, 1, 0) for i in range(1, 150))


def test_empty_and_no_python(spark):
    assert run(spark, []) == []
    lines = quote_links.lines_of(spark.createDataFrame([(1, "t", "a")], "id long, t string, text string"))
    assert "Python" not in lines._jdf.queryExecution().executedPlan().toString()
