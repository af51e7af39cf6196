import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.functions import nested, numeric, precision, predicates, rules, text


def value(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{n} {'double' if isinstance(values[n], float) else 'bigint' if isinstance(values[n], int) and not isinstance(values[n], bool) else 'boolean' if isinstance(values[n], bool) else 'string'}"
        for n in names)) if names else spark.range(1)
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize("name,want", [("AA-BR-01Z-00-DX1.1A2B.svs", "AA-BR-01Z-00-DX1"), ("AA-BR-01Z-00-DX1", "AA-BR-01Z-00-DX1")])
def test_slide_id(spark, name, want):
    assert value(spark, text.slide_id_from_filename(F.col("n")), n=name) == want


@pytest.mark.parametrize("name,want", [("A-00-DX1.1A2B.svs", "DX1"), ("A-01-BS12.x.svs", "BS12"), ("plain.svs", "")])
def test_slide_type(spark, name, want):
    assert value(spark, text.slide_type(F.col("n")), n=name) == want


@pytest.mark.parametrize("path,ext,stem,name", [
    ("/a/b/X.Y.SVS", ".svs", "X.Y", "X.Y.SVS"), ("s3://b/k/noext", "", "noext", "noext"), ("/a/.hidden", "", ".hidden", ".hidden")])
def test_path_parts(spark, path, ext, stem, name):
    df = spark.createDataFrame([(path,)], "p string")
    got = df.select(text.extension(F.col("p")), text.stem(F.col("p")), text.basename(F.col("p"))).first()
    assert tuple(got) == (ext, stem, name)


def test_download_uri(spark):
    df = spark.createDataFrame([("gdc://id1/a/b.svs", None, None), ("s3://x/y", "", ""), ("gdc://id2/n", "own", "f")],
                               "p string, i string, n string")
    a, b = text.fill_from_uri(F.col("p"), F.col("i"), F.col("n"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [("id1", "a/b.svs"), ("", ""), ("own", "f")]


@pytest.mark.parametrize("s,want", [("0:01:00", 60), ("2:30:00", 9000), ("1-02:03:04", 93784), ("45:10", 2710), ("7", 7), ("bad", None), ("", None)])
def test_elapsed(spark, s, want):
    assert value(spark, text.elapsed_seconds(F.col("s")), s=s) == want


@pytest.mark.parametrize("s,want", [(30, "<1m"), (3700, "1h 1m"), (93784, "1d 2h 3m"), (60, "0h 1m")])
def test_pretty(spark, s, want):
    assert value(spark, text.pretty_duration(F.col("s")), s=s) == want


def test_batch_age(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    assert value(spark, text.is_stale_batch(F.col("b"), now), b="20240101T120000_abcd1234") is True
    assert value(spark, text.is_stale_batch(F.col("b"), now), b="20240102T120000_abcd1234") is False
    assert value(spark, text.is_stale_batch(F.col("b"), now), b="legacy-batch") is False


def test_job_texts(spark):
    work = "/work/batch_20240101T120000_abcd1234/work/ab/cd"
    assert value(spark, text.batch_id_of_workdir(F.col("w")), w=work) == "20240101T120000_abcd1234"
    assert value(spark, text.process_short_name(F.col("n")), n="nf-EXTRACT_FEATURES_ (12)") == "EXTRACT_FEATURES_"
    log = "old\nexecutor > a\n\x1b[32mexecutor > b\x1b[0m\r\nlast"
    assert value(spark, text.last_progress_block(F.col("l")), l=log) == "executor > b\nlast"


@pytest.mark.parametrize("err,code,state,want", [
    ("CUDA out of memory", "1:0", "FAILED", "oom_gpu"), ("", "137:0", "FAILED", "oom_host"), ("slurm oom-kill event", "1:0", "FAILED", "oom_host"),
    ("", "143:0", "FAILED", "sigterm"), ("", "0:0", "CANCELLED by 1", "sigterm"), ("No space left on device", "1:0", "FAILED", "disk_full"),
    ("s3://b/k Exception", "1:0", "FAILED", "s3_error"), ("Traceback (most recent call last):", "1:0", "FAILED", "python_error"),
    ("", "0:0", "TIMEOUT", "timeout"), ("", "1:0", "FAILED", "error_exit1"), ("", "2:0", "FAILED", "unknown")])
def test_failure_class(spark, err, code, state, want):
    assert value(spark, text.failure_class(F.col("e"), F.col("c"), F.col("s")), e=err, c=code, s=state) == want


def test_volumes_and_models(spark):
    assert value(spark, text.table_to_volume(F.col("t")), t="a.b.c") == "/Volumes/a/b/c"
    assert value(spark, text.volume_to_table(F.col("t")), t="/Volumes/a/b/c/x.parquet") == "a.b.c"
    assert value(spark, text.base_model(F.col("m")), m="opt_bfloat16") == "opt"
    assert value(spark, text.precision_label(F.col("m")), m="opt_bfloat16") == "bfloat16"
    assert value(spark, text.precision_label(F.col("m")), m="opt") == "float32"
    assert value(spark, text.manifest_key(F.col("p")), p="features/opt/x.features.pt") == "opt_features_tensor_path"
    assert value(spark, text.manifest_key(F.col("p")), p="features/opt/pt/sub/x.features.pt") == "opt_features_tensor_path"


@pytest.mark.parametrize("run,want", [("dispatcher_r0a1b2c3d", "0a1b2c3d"), ("r0a1b2c3d", "0a1b2c3d"), ("0a1b2c3d", "0a1b2c3d"),
                                      ("dispatcher_20240101T120000_0a1b2c3d", "20240101T120000_0a1b2c3d")])
def test_run_suffix(spark, run, want):
    assert value(spark, text.run_suffix(F.col("r")), r=run) == want


@pytest.mark.parametrize("v,want", [("1.5", 1.5), ("", None), ("bad", None), (" 2 ", 2.0)])
def test_to_number(spark, v, want):
    assert value(spark, numeric.to_number(F.col("v")), v=v) == want


@pytest.mark.parametrize("v,want", [("True", True), ("false", False), ("", None), ("NA", None)])
def test_to_flag(spark, v, want):
    assert value(spark, numeric.to_flag(F.col("v")), v=v) is want


def test_mpp(spark):
    assert value(spark, numeric.native_mpp(F.col("v")), v="-1") is None
    assert value(spark, numeric.mpp_is_fallback(F.col("v")), v="svs_no_mpp") is True
    assert value(spark, numeric.mpp_is_fallback(F.col("v")), v="svs") is False
    assert value(spark, numeric.mpp_is_fallback(F.col("v")), v="") is None
    assert value(spark, numeric.tiling_mpp(F.col("n"), F.lit(True)), n=0.25) == 0.5


def test_percentage_and_bands(spark):
    assert value(spark, numeric.percentage(F.col("a"), F.col("b")), a=12502, b=11802) == 100.0
    assert value(spark, numeric.percentage(F.col("a"), F.col("b")), a=1, b=3) == 33.3
    assert value(spark, numeric.percentage(F.col("a"), F.col("b")), a=1, b=0) == 0.0
    assert [value(spark, numeric.delta_band(F.col("d")), d=d) for d in (-0.0005, 0.005, 0.5, float("nan"))] == ["negligible", "small", "large", None]
    assert value(spark, numeric.finite(F.col("d")), d=float("inf")) is None
    down, up = numeric.ci_half_widths(F.col("m"), F.col("l"), F.col("h"))
    assert value(spark, down, m=0.5, l=0.6, h=0.9) == 0.0
    assert value(spark, up, m=0.5, l=0.6, h=0.9) == pytest.approx(0.4)


def test_portable_hash_spreads(spark):
    h = spark.range(10000).select(numeric.portable_hash(F.col("id"), seed=42).alias("h"))
    counts = h.groupBy(F.floor(F.col("h") / 2**28)).count().toPandas()["count"]
    assert len(counts) == 16 and counts.min() > 400 and counts.max() < 900


def test_nested(spark):
    df = spark.createDataFrame([([(None,), ("x",), ("y",)],), ([],), (None,)], "d array<struct<f:string>>")
    assert [r[0] for r in df.select(nested.first_value(F.col("d"), "f")).collect()] == ["x", None, None]
    assert [r[0] for r in df.select(nested.first_element(F.col("d")).isNull()).collect()] == [False, True, True]


def test_rules(spark):
    assert value(spark, rules.shard_group(F.col("c"), True), c="BRCA") == "BRCA"
    assert value(spark, rules.shard_group(F.col("c"), True), c="") == "all"
    assert value(spark, rules.shard_group(F.col("c"), False), c="BRCA") == "all"
    assert value(spark, rules.resolve_precision(F.col("m"), {"a": "float16"}, "bfloat16"), m="a") == "float16"
    assert value(spark, rules.resolve_precision(F.col("m"), {"a": "float16"}, "bfloat16"), m="b") == "bfloat16"
    assert value(spark, rules.resolve_precision(F.col("m")), m="b") == "float32"
    assert value(spark, rules.patch_encoder(F.col("m")), m="titan_slide") == "conch1_5"
    assert value(spark, rules.patch_encoder(F.col("m")), m="uni") == "uni"
    assert value(spark, rules.aggregation_method(F.col("m")), m="titan_slide") == "model"
    assert value(spark, rules.resolve_batch_size(F.col("m"), {"Virchow2": 256}), m="virchow2") == 256
    assert rules.artifact_classes([1], True, True) == [1]
    assert rules.artifact_classes(None, True, True) == [2, 3, 4, 5, 6, 7]
    assert rules.artifact_classes(None, False, True) == [4, 7]
    assert rules.artifact_classes(None, False, False) == []
    assert value(spark, rules.failure_reason(F.col("s"), F.col("r")), s="FAILED", r="") == "Failed after max retries"
    assert value(spark, rules.failure_reason(F.col("s"), F.col("r")), s="PENDING", r="old") == ""


def test_predicates(spark):
    assert value(spark, predicates.slide_type_in(F.col("t"), "DX1"), t="DX10") is True
    assert value(spark, predicates.slide_type_in(F.col("t"), "DX1", exact=True), t="DX10") is False
    assert value(spark, predicates.slide_type_in(F.col("t"), "all"), t="BS1") is True
    assert value(spark, predicates.sample_type_in(F.col("t"), "tumor, metast"), t="Primary Tumor") is True
    assert value(spark, predicates.sample_type_in(F.col("t"), "tumor"), t="Blood Derived Normal") is False
    assert value(spark, predicates.project_in(F.col("t"), "A, B"), t="B") is True
    for name, want in (("/a/x.svs", True), ("/a/x.svs.part", False), ("/a/x.TMP", False), ("/a/.x.svs", False)):
        assert value(spark, predicates.settled_name(F.col("p")), p=name) is want
    assert value(spark, predicates.within_retry_budget(F.col("n"), 0), n=99) is True
    assert value(spark, predicates.within_retry_budget(F.col("n"), 3), n=3) is False
    assert value(spark, predicates.failed_for(F.col("s"), F.col("m"), ["UNI"]), s="Failed", m="uni") is True
    now, old = F.lit("2024-01-02").cast("timestamp"), F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert value(spark, predicates.stuck(F.col("s"), F.col("p"), old, now, 4), s="RUNNING", p=7) is True
    assert value(spark, predicates.stuck(F.col("s"), F.col("p"), old, now, 0), s="RUNNING", p=7) is False
    assert value(spark, predicates.fresh(old, now, 24)) is True
    assert value(spark, predicates.fresh(old, now, 24, force=True)) is False
    assert value(spark, F.size(predicates.sheet_reasons(F.col("a"), F.col("b"))), a="s 1", b="/x.jpg") == 2
    assert value(spark, F.size(predicates.sheet_reasons(F.col("a"), F.col("b"))), a="s1", b="/x.SVS") == 0


def test_precisions_against_numpy(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=500), [0.0, -0.0, 1e-8, 65504, 70000, 3.4e38, np.inf, -np.inf, np.nan]]).astype(np.float32)
    df = spark.createDataFrame([(values.tolist(),), (None,), ([],)], "f array<float>")
    half = df.select(precision.cast_precision(F.col("f"), "float16").alias("f")).collect()
    with np.errstate(over="ignore"):
        np.testing.assert_array_equal(np.array(half[0].f, np.float32), values.astype(np.float16).astype(np.float32))
    assert half[1].f is None and half[2].f == []
    back = df.select(precision.bfloat16_decode(precision.bfloat16_encode(F.col("f"))).alias("f")).first().f
    got, finite = np.array(back, np.float32), np.isfinite(values)
    assert np.isnan(got[-1]) and np.isinf(got[-2])
    assert np.all(np.abs(got[finite & (values != 0) & (np.abs(values) < 1e38)] / values[finite & (values != 0) & (np.abs(values) < 1e38)] - 1) <= 2**-8)
    ties = np.array([1 + 2**-8, 1 + 3 * 2**-8], np.float32)
    np.testing.assert_array_equal(precision.round_to(ties, "bfloat16"), np.array([1.0, 1 + 2**-6], np.float32))
    assert df.select(precision.cast_precision(F.col("f"), "int8").alias("f")).first().f[0] == pytest.approx(values[0])


def test_cast_to_mixed_targets(spark):
    x = 1 + 2**-9
    df = spark.createDataFrame([(i, [x, float(i)], t) for i, t in enumerate(["float16", "bfloat16", None, "float32", "float16"])] + [(9, None, "float16")],
                               "i int, f array<float>, t string").coalesce(1)
    got = {r.i: r.f for r in df.select("i", precision.cast_to(F.col("f"), F.col("t")).alias("f")).collect()}
    assert got == {0: [x, 0.0], 1: [1.0, 1.0], 2: [x, 2.0], 3: [x, 3.0], 4: [x, 4.0], 9: None}


def test_elapsed_text_is_parsed_once(spark, tmp_path):
    """The pattern of a duration stands once in the plan of the query, however often the seconds are used."""
    from lamella.plans import QUERIES

    spark.range(3).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id * 900 AS l_partkey", "id AS l_suppkey", "12.0D AS l_quantity",
                              "timestamp '2024-01-01' AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = QUERIES["elapsed_text"](spark, str(tmp_path))
    assert [(r.seconds, r.pretty) for r in df.orderBy("l_orderkey").collect()] == [(0, "<1m"), (108000, "1d 6h 0m"), (216000, "2d 12h 0m")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and plan.lower().count("split(") == 0 and "regexp_" not in plan


@pytest.mark.parametrize("s,want", [("2-7", 172807), ("1-02:03", 86523), (" 0:01:00 ", 60), ("1:2:3:4", None), ("1-", None), ("-5", None), ("1-2-3", None), ("5:", None), ("99999999999999999999", 0)])
def test_elapsed_edges(spark, s, want):
    assert value(spark, text.elapsed_seconds(F.col("s")), s=s) == want
