"""CSV sheets, manifests and scheduler text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella import schemas
from lamella.functions import numeric, predicates, rules, text
from lamella.operators import quality
from lamella.operators.batching import with_sample_sizes
from lamella.operators.ordered import first_per_key
from lamella.sources.files import path_exists


def _cells(line: Column) -> Column:
    """Cells of a comma-separated line, quotes kept; a comma inside double quotes is part of its cell. One pass over the line."""
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',([^",]*(?:"[^"]*"[^",]*)*)'), 1)


def string_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text, blanks for missing values."""
    frame = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return frame.na.fill("")


def _column(df: DataFrame, name: str):
    return text.blank_to_null(F.trim(name)) if name in df.columns else F.lit(None).cast("string")


def samples_scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) sample rows; valid ones carry sample_id, n_slides and the download fields."""
    raw = string_csv(spark, path)
    rows = raw.select(*[_column(raw, c).alias(c) for c in schemas.names(schemas.SAMPLES)])
    valid, rejected = quality.split_valid(quality.check_sheet(rows))
    file_id, file_name = text.fill_from_uri(F.col("slide_path"), F.col("file_id"), F.col("file_name"))
    named = valid.withColumns({
        "sample_id": rules.default_sample_id(F.col("sample_id"), F.col("slide_id")), "file_id": file_id,
        "file_name": file_name,
        "needs_download": F.coalesce(numeric.to_flag(F.col("needs_download")), F.lit(False))})
    return with_sample_sizes(named), rejected


def annotations_scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    raw = string_csv(spark, path)
    rows = raw.select(*[_column(raw, c).alias(c) for c in schemas.names(schemas.ANNOTATIONS)])
    good = (F.coalesce(F.col("slide_id").rlike(predicates.NO_SPACE_PATTERN), F.lit(False))
            & F.coalesce(F.lower("annotation_bmp_path").rlike(predicates.MASK_PATH_PATTERN), F.lit(False)))
    return rows.where(good), rows.where(~good)


def class_map_scan(spark: SparkSession, path: str) -> DataFrame:
    """(oncotree_code, class) of the rows with exactly two cells; the header is skipped."""
    lines = spark.read.text(path).select(_cells(F.col("value")).alias("cells"))
    pairs = lines.where(F.size("cells") == 2).select(
        F.trim(F.col("cells")[0]).alias("oncotree_code"), F.trim(F.col("cells")[1]).alias("class"))
    return pairs.where(~((F.col("oncotree_code") == "oncotree_code") & (F.col("class") == "class")))


def shard_manifest_scan(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> DataFrame:
    """(slide_id, model, wds_path); an absent file gives an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.SHARD_MANIFEST)
    rows = string_csv(spark, path).select("slide_id", "model", "wds_path")
    return rows.where(predicates.in_models(F.col("model"), models))


def mpp_scan(spark: SparkSession, path: str) -> DataFrame:
    """(slide_id, native_mpp, mpp_is_fallback); the last row per slide of the newest file wins."""
    raw = (spark.read.option("header", True).csv(path)
           .withColumns({"_at": F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start"),
                         "_no": F.monotonically_increasing_id()}).na.fill(""))
    source = F.col("source") if "source" in raw.columns else F.lit("")
    rows = raw.where(F.col("slide_id") != "").select(
        "slide_id", numeric.native_mpp(F.col("native_mpp")).alias("native_mpp"),
        numeric.mpp_is_fallback(source).alias("mpp_is_fallback"), "_at", "_no")
    return first_per_key(rows, ["slide_id"], [F.col("_at"), F.col("_no")], last=True).drop("_at", "_no")


def failures_from_state(state: DataFrame, default: str = "Failed after max retries") -> DataFrame:
    failed = state.where(F.col("status") == "FAILED")
    return failed.select("slide_id", F.coalesce(text.blank_to_null(F.col("error_msg")), F.lit(default)).alias("reason"))


def failure_scan(spark: SparkSession, path: str) -> DataFrame:
    """(slide_id, reason) from a CSV whose reason column is ``failure_reason`` or ``error_msg``."""
    raw = string_csv(spark, path)
    columns = [F.col(c) for c in ("failure_reason", "error_msg") if c in raw.columns]
    return raw.select("slide_id", (columns[0] if columns else F.lit("")).alias("reason"))


def parse_manifest_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed) of manifest lines: ``value`` plus any other columns, which are kept.

    Lines have four cells, or five in the older form whose second is dropped.
    """
    quoted = r'^"(.*)"$'
    unquoted = F.transform(_cells(F.col("value")), lambda c: F.when(
        c.rlike(quoted), F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"'))).otherwise(c))
    cells = F.when(F.col("value").contains('"'), unquoted).otherwise(F.split("value", ","))
    rest = [c for c in lines.columns if c != "value"]
    split = lines.where(F.trim("value") != "").select("value", *rest, cells.alias("cells"))
    arity = F.size("cells")
    old = (arity == 5).cast("int")
    names = ["workflow_id", "key"]
    good = split.where(arity.isin(4, 5)).select(
        F.col("cells")[0].alias("slide_id"), *[F.get("cells", old + i + 1).alias(n) for i, n in enumerate(names)],
        F.get("cells", old + 3).alias("value"), *rest)
    return good, split.where(~arity.isin(4, 5)).drop("cells")


def manifest_scan(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed) of headerless manifest files, with file path, time and line order."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("line_no"))
    return parse_manifest_lines(lines)


def _delimited(lines: DataFrame, schema: str) -> DataFrame:
    cells = F.split(F.trim("value"), r"\|")
    names = schemas.names(schema)
    rows = lines.where(F.size(cells) >= len(names)).select(*[F.trim(cells[i]).alias(n) for i, n in enumerate(names)])
    return rows.where(F.col("name").startswith(text.JOB_PREFIX) & ~F.col("job_id").contains("."))


def jobs_scan(spark: SparkSession, path: str) -> DataFrame:
    """Current scheduler jobs; short lines, other people's jobs and job steps are dropped."""
    return _delimited(spark.read.text(path), schemas.JOBS)


def job_history_scan(spark: SparkSession, path: str) -> DataFrame:
    return _delimited(spark.read.text(path), schemas.JOB_HISTORY)


def trace_scan(spark: SparkSession, path: str) -> DataFrame:
    return string_csv(spark, path, sep="\t")
