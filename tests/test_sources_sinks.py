import io
import json
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.operators import batching, embed, manifest, progress, quality, sharding
from lamella.sinks import tables
from lamella.sources import documents, files, sheets, shards
from tests.conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_samples(spark, tmp_path):
    path = write(tmp_path / "s.csv", "slide_id,slide_path,sample_id,needs_download\nA,/x/a.svs,P,\nB,/x/b.tiff,P,\nC,gdc://id1/c.svs,,TRUE\n"
                                     "bad id,/x/d.svs,,\nD,/x/d.jpg,,\n,/x/e.svs,,\n")
    valid, rejected = sheets.samples_scan(spark, path)
    assert rows(valid, "slide_id", "sample_id", "n_slides", "needs_download", "file_id", "file_name") == [
        ("A", "P", 2, False, None, None), ("B", "P", 2, False, None, None), ("C", "C", 1, True, "id1", "c.svs")]
    assert rejected.count() == 3 and rejected.where(F.size("reasons") == 0).count() == 0


def test_small_sheets(spark, tmp_path):
    good, bad = sheets.annotations_scan(spark, write(tmp_path / "a.csv", "slide_id,annotation_bmp_path\nA,/m/a.bmp\nB,/m/b.png\n"))
    assert rows(good, "slide_id") == [("A",)] and rows(bad, "slide_id") == [("B",)]
    classes = sheets.class_map_scan(spark, write(tmp_path / "c.csv", "oncotree_code,class\nBRCA,tumor\nBRCA,stroma\nodd,x,y\nLUAD,tumor\n"))
    slides = spark.createDataFrame([("s1", "BRCA"), ("s2", "ZZZ")], "slide_id string, oncotree_code string")
    got = rows(embed.slide_classes(slides, classes, ["d1", "d2"]), "slide_id", "classes")
    assert got == [("s1", ["stroma", "tumor"]), ("s2", ["d1", "d2"])]
    mapping = documents.class_mapping_scan(spark, write(tmp_path / "m.yaml", "# map\n1: 1   # tumour\n4: 0\nname: x\n"))
    assert rows(mapping) == [(1, 1), (4, 0)]
    mpp = sheets.mpp_scan(spark, write(tmp_path / "mpp.csv", "slide_id,native_mpp,source\nA,0.25,svs\nA,0.5,svs\nB,bad,svs_no_mpp\n,1,svs\nC,-1,\n"))
    assert rows(mpp) == [("A", 0.5, False), ("B", None, True), ("C", None, None)]
    failures = sheets.failure_scan(spark, write(tmp_path / "f.csv", "slide_id,error_msg\nA,boom\n"))
    assert rows(failures) == [("A", "boom")]
    assert sheets.shard_manifest_scan(spark, str(tmp_path / "none.csv")).count() == 0
    listed = sheets.shard_manifest_scan(spark, write(tmp_path / "w.csv", "slide_id,model,wds_path\nA,m1,x\nB,m2,y\n"), ["m1"])
    assert rows(listed) == [("A", "m1", "x")]


def test_manifest_files(spark, tmp_path):
    old = write(tmp_path / "manifest-1.csv", "s1,w,k1,old\ns2,pat,w,k1,five\nbad_line\n\n\"s,3\",w,k1,\"a \"\"q\"\"\"\n")
    new = write(tmp_path / "manifest-2.csv", "s1,w,k1,new\ns1,w,k2,v\ns1,w,k2,v2\n")
    os.utime(old, (1_600_000_000, 1_600_000_000))
    os.utime(new, (1_700_000_000, 1_700_000_000))
    good, bad = sheets.manifest_scan(spark, [old, new])
    assert rows(manifest.combine_manifests(good)) == [
        ("s,3", "w", "k1", 'a "q"'), ("s1", "w", "k1", "new"), ("s1", "w", "k2", "v2"), ("s2", "w", "k1", "five")]
    assert rows(bad, "value") == [("bad_line",)]
    wide = manifest.wide(manifest.combine_manifests(good), ["k1", "k2"], [F.col("value")])
    assert ("s1", "w", "new", "v2") in rows(wide)


def test_scheduler_text(spark, tmp_path):
    path = write(tmp_path / "q.txt", "1|nf-A (1)|RUNNING|(None)|gpu01|/w/batch_20240101T120000_abcd1234/x|2:30:00\n"
                                     "2|other|RUNNING|(None)|gpu01|/x|0:01:00\nshort|line\n3.batch|nf-A (2)|RUNNING||n|/x|0:01\n")
    assert rows(sheets.jobs_scan(spark, path), "job_id", "elapsed") == [("1", "2:30:00")]
    history = sheets.job_history_scan(spark, write(tmp_path / "h.txt", "7|nf-B|COMPLETED|0:0|1-00:00:00|/w\n8|nf-B|FAILED\n"))
    assert rows(history, "job_id", "state") == [("7", "COMPLETED")]
    trace = sheets.trace_scan(spark, write(tmp_path / "t.tsv", "task_id\tname\tstatus\n1\tT (a)\tFAILED\n2\tT (b)\tCACHED\n"))
    assert trace.count() == 2 and trace.columns == ["task_id", "name", "status"]


def test_listings(spark, tmp_path):
    for name in ("in/a.SVS", "in/b.svs.part", "in/.h.svs", "in/sub/c.tiff", "in/sub/d.txt"):
        write(tmp_path / name, "x" * 10)
    found = files.file_listing(spark, str(tmp_path / "in"), [".svs", ".tiff"])
    assert sorted(p.path.rsplit("/", 1)[-1] for p in found.collect()) == [ "a.SVS", "c.tiff"]
    keys = files.object_listing(spark, str(tmp_path / "in"))
    assert ("sub/c.tiff", 10) in rows(keys, "key", "length")
    assert files.file_listing(spark, str(tmp_path / "none")).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1]


def test_result_layouts(spark):
    names = ["r/features/m/S1.features.pt", "r/features/m/pt/a/S1.features.pt", "r/features/m/S2.features.pt", "r/features/m/S3.features.h5",
             "r/features/n/h5/S4.patch.h5", "r/features/m/x/S5.features.pt"]
    listing = spark.createDataFrame([(n,) for n in names], "path string")
    pt = files.parse_results(listing)
    assert rows(pt) == [("S1", "m", "r/features/m/pt/a/S1.features.pt"), ("S2", "m", "r/features/m/S2.features.pt")]
    assert rows(files.parse_results(listing, "h5"), "slide_id", "model") == [("S3", "m"), ("S4", "n")]
    assert rows(files.discover_models(pt)) == [("m",)]


def test_intake_rules(spark):
    listing = spark.createDataFrame([("/a/x.svs", 100), ("/a/y.svs.tmp", 100), ("/a/.z.svs", 100), ("/a/w.svs", 5), ("/a/up.svs", 100)], "path string, length bigint")
    uploads = spark.createDataFrame([("/a/up.svs",)], "key string")
    assert rows(files.intake_candidates(listing, uploads, [".svs"], 10), "slide_id") == [("x",)]


def test_hits(spark, tmp_path):
    full = {"file_id": "f1", "file_name": "A-00-DX1.x.svs", "file_size": 5, "cases": [{"submitter_id": "c", "project": {"project_id": "P"}, "demographic": {"age_at_index": 52},
            "diagnoses": [{"primary_diagnosis": None}, {"primary_diagnosis": "Ca", "tumor_grade": "G1"}],
            "samples": [{"sample_type": "Primary Tumor", "portions": [{"slides": [{"percent_tumor_cells": 60.0, "section_location": "TOP"}]}]}]}]}
    page = {"data": {"hits": [full, {"file_id": "f2"}, full, {"file_id": "f3", "cases": []}]}}
    got = {r.file_id: r for r in documents.hits_scan(spark, write(tmp_path / "p.json", json.dumps(page))).collect()}
    assert sorted(got) == ["f1", "f2", "f3"]
    assert (got["f1"].slide_type, got["f1"].project_id, got["f1"].primary_diagnosis, got["f1"].tumor_grade, got["f1"].percent_tumor_cells) == ("DX1", "P", "Ca", "G1", 60.0)
    assert got["f2"].sample_type is None and got["f2"].project_id is None


def test_sql_sources(spark, tmp_path):
    query = "SELECT 'a' AS slide_id, '/p' AS slide_path, '' AS oncotree_code, id FROM range(3) WHERE id >= :low"
    assert documents.sql_source(spark, query, {"low": 1}).count() == 2
    path = write(tmp_path / "q.sql", "-- note\n" + query.replace(":low", "2") + ";\n")
    assert documents.sql_file_source(spark, path).count() == 1
    assert documents.sql_file_source(spark, path, query, {"low": 0}).count() == 3
    with pytest.raises(ValueError):
        documents.sql_source(spark, "SELECT 1 AS slide_id")


def test_results_and_reports(spark, tmp_path):
    result = {"n_seeds": 5, "best_params": {"clf__C": 0.0}, "test": {"auroc": {"mean": None, "std": 0.1, "bootstrap_ci_95": [0.4, 0.6]}}}
    paths = {"m1": write(tmp_path / "a/results.json", json.dumps(result)), "m2": write(tmp_path / "b/results.json", json.dumps(result))}
    scanned = documents.metrics_json_scan(spark, paths)
    assert rows(scanned, "model") == [("m1",), ("m2",)]
    report = write(tmp_path / "r.csv", ",0,1,accuracy\nf1-score,0.5,0.7,\naccuracy,,,0.6\n")
    long = documents.report_csv_scan(spark, {"m1": report})
    assert rows(long, "class", "metric", "value") == [("0", "f1-score", 0.5), ("1", "f1-score", 0.7), ("accuracy", "accuracy", 0.6)]


def test_features(spark, tmp_path):
    matrix = spark.createDataFrame([("s", [[1.0, 2.0], [3.0, 4.0]])], "slide_id string, features array<array<float>>")
    assert rows(documents.explode_matrix(matrix)) == [("s", 0, [1.0, 2.0]), ("s", 1, [3.0, 4.0])]
    flat = spark.createDataFrame([("s", [1.0, 2.0])], "slide_id string, features array<float>")
    assert rows(documents.explode_matrix(flat)) == [("s", 0, [1.0, 2.0])]
    path = str(tmp_path / "f")
    flat.write.parquet(path)
    write(tmp_path / "f" / "broken.parquet", "no parquet")
    assert rows(documents.feature_scan(spark, path), "slide_id", "features", "model") == [("s", [1.0, 2.0], None)]
    skipped = {r.path.rsplit("/", 1)[-1] for r in documents.unreadable_files(spark, path).collect()}
    read = {r.name for r in documents.feature_scan(spark, path).select(F.col("_metadata.file_name").alias("name")).collect()}
    assert "broken.parquet" in skipped and not skipped & read
    usable, rejected = documents.feature_rejects(spark.createDataFrame([("a", [1.0]), ("b", []), ("c", None)], "slide_id string, features array<float>"))
    assert rows(usable, "slide_id") == [("a",)] and rejected.count() == 2


def test_snapshots_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("S123", 1), ("S129", None)], "slide_id string, v int")
    folder = str(tmp_path / "snap")
    from datetime import datetime, timezone
    for hour in (1, 3, 2):
        tables.snapshot_sink(df.withColumn("h", F.lit(hour)), folder, "status_", datetime(2024, 1, 1, hour, tzinfo=timezone.utc))
    assert files.latest_snapshot(spark, folder, "status_").first().h == 3
    with pytest.raises(FileNotFoundError):
        files.latest_snapshot(spark, folder, "other_")
    tables.csv_sink(df, str(tmp_path / "csv"))
    assert rows(sheets.string_csv(spark, str(tmp_path / "csv"))) == [("S123", "1"), ("S129", "")]
    tables.prefix_partition_sink(df, str(tmp_path / "pre"))
    assert os.path.isdir(tmp_path / "pre" / "prefix=S123")
    tables.replace_sink(df, str(tmp_path / "rep"))
    tables.replace_sink(df.limit(1), str(tmp_path / "rep"))
    assert spark.read.parquet(str(tmp_path / "rep")).count() == 1
    sheet = spark.createDataFrame([("b1", "s1"), ("b2", "s2")], "batch_id string, slide_id string")
    tables.batch_sheet_sink(sheet, str(tmp_path / "sheets"))
    assert os.path.isdir(tmp_path / "sheets" / "batch_id=b2")
    tables.validation_report_sink(sheet, str(tmp_path / "rep.txt"))
    assert rows(spark.read.text(str(tmp_path / "rep.txt"))) == [("b1\ts1",), ("b2\ts2",)]
    tables.manifest_sink([spark.createDataFrame([("a", "w", "k", "v")], "slide_id string, workflow_id string, key string, value string")] * 2, str(tmp_path / "man"))
    assert spark.read.text(str(tmp_path / "man")).count() == 2
    assert tables.audit_sink(spark, str(tmp_path / "audit"), "f", 1, 2, "t") is True
    assert tables.audit_sink(spark, "nosuchfs://x", "f", 1, 2, "t") is False
    tables.sync_status_sink(spark, str(tmp_path / "sync"), True, "done", 3)
    assert spark.read.json(str(tmp_path / "sync")).first().rows == 3
    assert tables.written_rows(spark, str(tmp_path / "pre")) == 2


def test_merge_sink_versions(spark, tmp_path):
    folder = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(2, "B", 1.0), (3, "c", 2.0)], "id int, v string, w double")
    assert tables.merge_sink(one, folder, ["id"], 0).count() == 2
    assert rows(tables.merge_sink(two, folder, ["id"], 1)) == [(2, "B", 1.0), (3, "c", 2.0)]
    assert rows(tables.merge_sink(one, folder, ["id"], 2, delete_missing=False)) == [(1, "a", None), (2, "b", 1.0), (3, "c", 2.0)]


@pytest.fixture(scope="module")
def tile_rows(spark):
    rng = np.random.default_rng(1)
    data = [(f"s{i:02d}", "m", t, [float(v) for v in rng.normal(size=8).astype(np.float32)], t * 64, i, precision)
            for i, precision in enumerate(["float32", "float16", "bfloat16"] * 3) for t in range(3 + i)]
    return spark.createDataFrame(data, "slide_id string, model string, tile_idx int, features array<float>, x bigint, y bigint, precision string")


def test_shard_round_trip(spark, tmp_path, tile_rows):
    folder = str(tmp_path / "wds")
    sizes = tile_rows.groupBy("model", "slide_id").agg((F.count("*") * 32).alias("bytes")).withColumn("group", F.lit("all"))
    assigned = sharding.assign_by_bytes(sizes, ["model", "group"], ["slide_id"], "bytes", 600)
    tables.shard_sink(tile_rows.repartition(4), assigned, folder)
    names = sorted(os.listdir(tmp_path / "wds" / "m" / "all"))
    assert names == sorted({r.shard_file for r in assigned.collect()}) and len(names) > 2
    assert not [n for n in os.listdir(tmp_path / "wds") if n.startswith("_staging")]
    with tarfile.open(tmp_path / "wds" / "m" / "all" / names[0]) as tar:
        members = tar.getmembers()
        assert [m.name for m in members[:2]] == ["s00.features.npy", "s00.coords.npy"]
        assert {(m.mtime, m.uid, m.gid) for m in members} == {(0, 0, 0)}
        assert [m.name.split(".")[0] for m in members] == sorted(m.name.split(".")[0] for m in members)
        stored = {m.name: np.load(io.BytesIO(tar.extractfile(m).read())) for m in members}
    assert stored["s00.features.npy"].shape == (3, 8) and stored["s00.coords.npy"].dtype == np.int64
    back = shards.shard_scan(spark, folder)
    got = {(r.slide_id, r.tile_idx): r for r in back.collect()}
    want = {(r.slide_id, r.tile_idx): r for r in tile_rows.collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert (got[key].x, got[key].y, got[key].precision) == (row.x, row.y, row.precision)
        np.testing.assert_allclose(got[key].features, row.features, rtol={"float32": 0, "float16": 1e-3, "bfloat16": 8e-3}[row.precision], atol=1e-4)
    checked = quality.check_shards(shards.shard_members(spark, folder))
    assert checked.where("error IS NOT NULL").count() == 0 and checked.count() == len(names)


def test_shard_problems_are_found(spark, tmp_path):
    (tmp_path / "m" / "g").mkdir(parents=True)
    with tarfile.open(tmp_path / "m" / "g" / "000000.tar", "w"):
        pass
    with tarfile.open(tmp_path / "m" / "g" / "000001.tar", "w") as tar:
        tar.addfile(tarfile.TarInfo("s.coords.npy"))
    checked = quality.check_shards(shards.shard_members(spark, str(tmp_path)))
    assert sorted(r.error for r in checked.collect()) == ["empty shard", "no feature entry"]


def test_shards_without_coords(spark, tmp_path, tile_rows):
    rows_ = tile_rows.where("slide_id = 's00'").drop("x", "y")
    assigned = spark.createDataFrame([("m", "all", "s00", "000000.tar")], "model string, group string, slide_id string, shard_file string")
    tables.shard_sink(rows_, assigned, str(tmp_path / "w"))
    back = shards.shard_scan(spark, str(tmp_path / "w"))
    assert back.count() == 3 and back.where("x IS NOT NULL").count() == 0


def test_quality(spark):
    expected = spark.createDataFrame([("a", 5), ("b", 6), ("c", 0), ("d", 1)], "key string, size bigint")
    listing = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9)], "key string, length bigint")
    assert rows(quality.check_sizes(expected, listing), "key", "state") == [("a", "ok"), ("b", "partial"), ("c", "ok"), ("d", "missing")]
    assert rows(tables.sizes_match(expected, listing), "key") == [("b",), ("d",)]
    with pytest.raises(ValueError):
        quality.require_columns(expected, ["key"], exact=True)
    good, bad = quality.split_errors(spark.createDataFrame([(1, None), (2, "x")], "v int, error string"))
    assert rows(good) == [(1,)] and rows(bad) == [(2, "x")]


def test_shard_listing_and_attributes(spark, tmp_path):
    for name in ("m1/all/000000.tar", "m1/all/000001.tar", "m1/wds_index.json", "m2/g/000000.tar"):
        write(tmp_path / name, "x")
    counts = progress.shard_counts(files.shard_listing(spark, str(tmp_path)))
    assert rows(counts) == [("m1", 3, 2), ("m2", 1, 1)]
    meta = spark.createDataFrame([("a", 0.25, True, "t/a"), ("b", None, None, None)], "slide_id string, native_mpp double, mpp_is_fallback boolean, tiles string")
    assert rows(manifest.grid_attributes(meta, "w", ["tiles"]), "slide_id", "key", "value") == [
        ("a", "mpp_is_fallback", "true"), ("a", "native_mpp", "0.25"), ("a", "tiles", "t/a"), ("b", "mpp_is_fallback", "unknown"), ("b", "native_mpp", "unknown")]
    lists = spark.createDataFrame([("b1", ["a", "b"], [1, 2])], "batch string, slide_id array<string>, out array<int>")
    assert rows(batching.transpose(lists, ["slide_id", "out"])) == [("b1", "a", 1), ("b1", "b", 2)]


def test_existing_shards_are_never_replaced(spark, tmp_path, tile_rows):
    folder = str(tmp_path / "wds")
    assigned = tile_rows.select("model", "slide_id").distinct().withColumns({"group": F.lit("g"), "shard_file": F.lit("000000.tar")})
    first, second = assigned.where("slide_id = 's00'"), assigned.where("slide_id = 's01'")
    tables.shard_sink(tile_rows, first, folder)
    with pytest.raises(Exception, match="exist already"):
        tables.shard_sink(tile_rows, second, folder)
    assert {r.slide_id for r in shards.shard_scan(spark, folder).collect()} == {"s00"}
    assert not [n for n in os.listdir(folder) if n.startswith("_staging")]
