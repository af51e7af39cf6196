"""Nested documents, queries, features, labels and benchmark results."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella import schemas
from lamella.operators import quality
from lamella.operators.inventory import flatten_hits
from lamella.session import open_path

QUERY_COLUMNS = ["slide_id", "slide_path", "oncotree_code"]


def hits_scan(spark: SparkSession, path: str, paged: bool = True) -> DataFrame:
    """Flat inventory rows of fetched JSON pages (``data.hits[]``) or of one document per line."""
    if not paged:
        return flatten_hits(spark.read.schema(schemas.HITS).json(path))
    page = f"data struct<hits:array<struct<{schemas.HITS}>>>"
    pages = spark.read.schema(page).option("multiLine", True).json(path)
    return flatten_hits(pages.select(F.explode("data.hits").alias("hit")).select("hit.*"))


def sql_source(spark: SparkSession, query: str, args: Mapping | None = None) -> DataFrame:
    """Slides of a user's query; it must return the three contract columns."""
    return quality.require_columns(spark.sql(query, args=dict(args or {})), QUERY_COLUMNS).select(*QUERY_COLUMNS)


def sql_file_source(spark: SparkSession, path: str | None = None, query: str | None = None,
                    args: Mapping | None = None) -> DataFrame:
    """As ``sql_source``; an inline query takes priority over the file."""
    if query is None:
        if path is None:
            raise ValueError("give a query or a query file")
        query = spark.read.text(path, wholetext=True).first()[0]
    return sql_source(spark, query.strip().rstrip(";"), args)


def feature_scan(spark: SparkSession, path: str, schema: str = schemas.FEATURES) -> DataFrame:
    """Tile feature rows; unreadable files are skipped, and ``unreadable_files`` lists them. The schema is given, so none of them is
    asked for it. The checksums of the pages are verified: values that were changed in place are not taken for sound ones."""
    return (spark.read.schema(schema).option("ignoreCorruptFiles", True)
            .option("parquet.page.verify-checksum.enabled", "true").parquet(path))


def _plain_path(name: str | Column) -> Column:
    return F.regexp_replace(name, "^([A-Za-z0-9]+):/+", "$1:/")  # sources write a scheme with one or three slashes


def footer_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, stated) of every file below a folder: the rows its footer states, NULL where that cannot be read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stated = []
            for name in batch.column(0).to_pylist():
                try:
                    filesystem, inner = open_path(name)
                    with filesystem.open_input_file(inner) as file:
                        stated.append(pq.read_metadata(file).num_rows)
                except (OSError, pa.ArrowException):
                    stated.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stated, pa.int64())], names=["path", "stated"])
    files = listed.repartition(F.col("path")).mapInArrow(look, "path string, stated bigint")
    return files.select(_plain_path("path").alias("path"), "stated")


def unreadable_files(spark: SparkSession, path: str, schema: str = schemas.FEATURES) -> DataFrame:
    """(path, stated, found) of the files below a folder of features that ``feature_scan`` does not give whole.

    ``found`` rows were decoded to the last value, of the ``stated`` ones of the footer (NULL: the file has none that can be
    read). So a file that is cut short shows, and one with a broken page in it.
    """
    rows = feature_scan(spark, path, schema)
    # One for each row, but only for who has read all of its columns: a broken page of any of them loses the rows.
    decoded = F.sum(F.pmod(F.hash(*rows.columns), F.lit(1)) + 1).cast("bigint")
    seen = rows.groupBy(_plain_path("_metadata.file_path").alias("path")).agg(decoded.alias("_n"))
    told = footer_rows(spark, path).join(seen, "path", "left").withColumn("found", F.coalesce("_n", F.lit(0))).drop("_n")
    return told.where(F.col("stated").isNull() | (F.col("found") < F.col("stated")) | (F.col("stated") == 0))


def explode_matrix(rows: DataFrame, features: str = "features") -> DataFrame:
    """One row per tile from slide rows holding an [N, D] matrix; a vector gives one row."""
    kind = rows.schema[features].dataType.simpleString()
    matrix = F.col(features) if kind.startswith("array<array") else F.array(features)
    rest = [c for c in rows.columns if c != features]
    return rows.select(*rest, F.posexplode(matrix).alias("tile_idx", features))


def feature_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected) feature rows; empty or NULL vectors are rejected, not fatal."""
    ok = F.coalesce(F.size("features") > 0, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def labels_scan(spark: SparkSession, path: str, target: str, split: str | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    columns = [F.col("slide_id"), F.col(target).cast("int").alias("label")]
    return rows.select(*columns, *([F.col(split).alias("split")] if split else []))


def class_mapping_scan(spark: SparkSession, path: str) -> DataFrame:
    """(raw, mapped) pairs of a ``raw: mapped`` file; comments and other lines are ignored."""
    pattern = r"^\s*(\d+)\s*:\s*(\d+)"
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    return lines.select(F.regexp_extract("value", pattern, 1).cast("int").alias("raw"),
                        F.regexp_extract("value", pattern, 2).cast("int").alias("mapped"))


def _model_of_file(paths: Mapping[str, str]) -> Column:
    """Model of the file being read; each path is a file or a folder of part files."""
    def own(path: str) -> Column:
        end = path.split("://", 1)[-1].strip("/")
        file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        return file.endswith(end) | file.contains(F.lit(f"/{end}/"))
    return F.coalesce(*[F.when(own(path), model) for model, path in paths.items()])


def metrics_json_scan(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Benchmark results of each model (model, n_seeds, best_params, val, test)."""
    files = spark.read.schema(schemas.METRIC_RESULTS).option("multiLine", True).json(list(paths.values()))
    return files.select(_model_of_file(paths).alias("model"), "*")


def report_csv_scan(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Classification reports in long form (model, class, metric, value), of all models in one scan.

    A report is a small file, read whole. Its own first line names its classes, so files may differ in their columns.
    """
    files = spark.read.text(list(paths.values()), wholetext=True).select(
        _model_of_file(paths).alias("model"), F.filter(F.split("value", "\r?\n"), lambda line: line != "").alias("lines"))
    width = files.agg(F.max(F.size(F.split(F.element_at("lines", 1), ",")))).first()[0] or 1
    fields = ", ".join(f"c{i} string" for i in range(width))

    def cells(line: Column) -> Column:
        parsed = F.from_csv(line, fields)
        return F.array(*[parsed[f"c{i}"] for i in range(width)])
    headed = files.select("model", cells(F.element_at("lines", 1)).alias("names"), F.explode(F.slice("lines", 2, F.size("lines"))).alias("line"))
    values = headed.select("model", "names", cells(F.col("line")).alias("v")).select(
        "model", F.col("v")[0].alias("metric"), F.posexplode(F.arrays_zip("names", "v")).alias("at", "cell"))
    return values.where((F.col("at") > 0) & F.col("cell.names").isNotNull()).select(
        "model", F.col("cell.names").alias("class"), "metric", F.col("cell.v").try_cast("double").alias("value")).where(F.col("value").isNotNull())
