"""The pipeline, stage by stage, against brute force on a small folder of tables."""

import zlib

import pytest

import corpus_pipeline
from lamella.llm import line_rules, packing, pii, simhash
from lamella.llm.tokens import default_vocabulary, encoder
from tests.llm.test_classifiers import texts
from tests.llm.test_line_rules import brute
from tests.llm.test_simhash import brute_components, slow_fingerprint


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made, rows = texts(240, seed=9), []
    for i, text, lang, _ in made:
        if i % 3:
            text += "\nplease write to me.you@example.com or call +1 (555) 010-9999 now"
        rows.append((i, text, lang, "hot" if i % 4 else "b", len(text)))
    rows += [(500 + i, rows[2 + i // 2][1], "en", "c", 10) for i in range(40)]
    rows += [(900, None, None, None, None), (901, "", "en", "b", 0), (902, "word " * 4000, "en", "b", 20_000), (None, rows[1][1], "en", "b", 3)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path + "/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, _, _, q in made], "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_each_stage(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "quality_classifier", "near_duplicates", "personal_data", "best_fit_packing"]
    rows = as_rows(docs)
    ruled = stages["quality_rules"](spark, docs, folder).cache()
    assert ruled.columns == docs.columns
    judged = brute([(r[0], r[1], r[3], None) for r in rows], line_rules.FLOOR, line_rules.SHARE)
    assert as_rows(ruled) == sorted(((r[0], j[8], *r[2:]) for r, j in zip(rows, judged) if j[7]), key=repr)

    scored = stages["quality_classifier"](spark, ruled, folder).cache()
    assert scored.columns == docs.columns
    good = {r.doc_id for r in spark.read.parquet(folder + "/labels.parquet").filter("quality = 1").collect()}
    bad = {i for i in range(240)} - good
    kept = {r.doc_id for r in scored.collect()}
    ruled_ids = {r.doc_id for r in ruled.collect()}
    assert len(good & ruled_ids - kept) <= 0.05 * len(good) and len(bad & kept) <= 0.05 * len(bad)

    single = stages["near_duplicates"](spark, scored, folder).cache()
    before = as_rows(scored)
    root = brute_components([slow_fingerprint(r[1]) for r in before])
    names = {}
    for r, g in zip(before, root):
        if r[0] is not None:
            names[g] = min(names.get(g, r[0]), r[0])
    assert as_rows(single) == [r for r, g in zip(before, root) if r[0] is None or r[0] == names[g]]

    hidden = stages["personal_data"](spark, single, folder).cache()
    anchors = pii.automaton()
    assert as_rows(hidden) == sorted(((r[0], pii.masked(r[1], pii.find(r[1], anchors)), *r[2:]) for r in as_rows(single)), key=repr)
    assert "example.com" not in "".join(r.text for r in hidden.collect()) and "010-9999" not in "".join(r.text for r in hidden.collect())

    placed = stages["best_fit_packing"](spark, hidden, folder).collect()
    own = encoder(default_vocabulary())
    want = []
    for r in as_rows(hidden):
        ids = own.encode(r[1]) + (packing.END_ID).to_bytes(4, "little")
        want += [(r[0], k, a, n, zlib.crc32(ids[4 * a:4 * (a + n)])) for k, (a, n) in enumerate(packing.bounds(len(ids) // 4, packing.CAPACITY))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed), key=repr) == sorted(want, key=repr)


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert as_rows(docs.select(*keys)) == as_rows(corpus_pipeline.run(spark, folder).select(*keys))


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
    assert simhash.keep_one(docs.sparkSession.read.parquet(folder + "/documents.parquet").limit(0)).count() == 0
