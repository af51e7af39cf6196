"""Line rules against a plain loop."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lamella.llm import line_rules

SCHEMA = "doc_id bigint, text string, source string, _words string"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def plain(line):
    return SPACES.sub(" ", re.sub("[1-9]", "0", line.lower())).strip(" ")


def brute(rows, floor, share):
    hosts, held = defaultdict(set), defaultdict(set)
    for _, text, source, _ in rows:
        hosts[source].add(text or "")
        for line in (text or "").split("\n"):
            if plain(line):
                held[source, plain(line)].add(text)
    over = {k for k, v in held.items() if len(v) > floor and len(v) > share * len(hosts[k[0]])}
    out = []
    for doc_id, text, source, _ in rows:
        text = text or ""
        words = [w for w in SPACES.split(text) if w]
        grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {i + o for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for o in range(5)}
        lines = [x for x in text.split("\n") if SPACES.sub("", x)]
        size = len(SPACES.sub("", text))
        left = "\n".join(x for x in text.split("\n") if (source, plain(x)) not in over)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        lost = size - len(SPACES.sub("", left)) >= line_rules.DEPLETED * size
        out.append((doc_id, len(words), size, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
                    len(covered), failed, not failed and not lost, left))
    return out


def sample():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé1#|") for _ in range(rng.randint(1, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, "\n".join(line(rng.randint(0, 9)) for _ in range(rng.randint(0, 12))), rng.choice(["hot", "hot", "b", None]), "x")
            for i in range(150)]
    rows += [(200 + i, f"{line(3)}\nAll Rights\treserved {i % 9}\nAll  rights reserved 7 ", "hot", None) for i in range(40)]
    rows += [(300 + i, f"{'All rights reserved 1 by the owners of this fine page and of many other pages'}\n{word()}", "hot", None) for i in range(40)]
    rows += [(400, None, None, None), (401, "", "b", ""), (402, " \n\t\n", "b", ""), (None, line(30), "b", ""),
             (403, " ".join(["same"] * 5000), "hot", ""), (404, "one two three four five six " * 3, "b", "")]
    rows += [(410 + i, f"{' a' * 12}\u2028 tail \x0b of line\u0085 x\r\n  all rights reserved 2 \n{i}", "hot", None) for i in range(9)]
    return rows + rows[5:8] + [(500 + i, rows[3][1], "hot", "") for i in range(60)]


def run(spark, rows, floor=5, share=0.05):
    got = line_rules.judge(spark.createDataFrame(rows, SCHEMA), floor=floor, share=share)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rest"]
    return sorted(map(tuple, got.select(*names).collect()), key=repr)


def test_equals_loop(spark):
    rows = sample()
    assert run(spark, rows) == sorted(brute(rows, 5, 0.05), key=repr)


def test_both_ways_to_remove_lines_agree(spark, monkeypatch):
    rows = sample()
    named = run(spark, rows)
    assert any(not r[7] and not r[6] for r in named)
    monkeypatch.setattr(line_rules, "LISTED", 0)
    assert run(spark, rows) == named


def test_empty_table_and_columns_stay(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame(sample(), SCHEMA).withColumn("n_words", F.lit("mine"))
    kept = line_rules.clean(docs)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < docs.count()


def test_runs_no_python(spark):
    plan = line_rules.judge(spark.createDataFrame(sample(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
