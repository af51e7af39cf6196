"""Listings of files and objects. File contents are never read: the column is pruned from the scan."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import predicates, text
from lamella.operators.ordered import first_per_key

LISTING = "path string, length bigint, modified timestamp"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).exists(target)


#: Name of the file that tells readers which index is the current one.
POINTER = "CURRENT"


def replace_text(spark: SparkSession, path: str, content: str) -> None:
    """A small text file replaced in one step (by rename, where the store has one)."""
    jvm, gateway, conf = spark.sparkContext._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}")
    filesystem = target.getFileSystem(conf)
    out = filesystem.create(draft, True)
    out.write(bytearray(content.encode()))
    out.close()
    overwrite = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(filesystem.getUri(), conf)
    context.rename(filesystem.makeQualified(draft), filesystem.makeQualified(target), overwrite)


def current_index(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The published shard index; empty while there is none. It stays the same for whoever has it, also when a newer one is published."""
    pointer = f"{folder.rstrip('/')}/{POINTER}"
    if not path_exists(spark, pointer):
        return spark.createDataFrame([], schema)
    name = spark.read.text(pointer).first()[0]
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}")


def file_listing(spark: SparkSession, root: str, extensions: Sequence[str] | None = None,
                 recursive: bool = True) -> DataFrame:
    """(path, length, modified) of the files below ``root`` with an allowed suffix."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], LISTING)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    return files.where(predicates.allowed_extension(F.col("path"), extensions)) if extensions else files


def object_listing(spark: SparkSession, prefix: str) -> DataFrame:
    """(key, length, modified) below a prefix, keys relative to it; one listing instead of a probe per file."""
    base = prefix.rstrip("/") + "/"
    marker = base.split("://", 1)[-1].lstrip("/")
    relative = F.substring_index("path", marker, -1)
    return file_listing(spark, prefix).select(relative.alias("key"), "length", "modified")


def parse_results(listing: DataFrame, kind: str = "pt") -> DataFrame:
    """(slide_id, model, path) of feature files in a listing.

    Known layouts: ``features/<model>/X.features.<kind>`` and the older
    ``features/<model>/<kind>/…``, which wins when both exist.
    """
    suffix = {"pt": ("features.pt", "features.pt"), "h5": ("features.h5", "patch.h5")}[kind]
    flat = r"(?:^|/)features/([^/]+)/([^/]+)\." + suffix[0].replace(".", r"\.") + "$"
    nested = r"(?:^|/)features/([^/]+)/" + kind + r"/(?:.*/)?([^/]+)\." + suffix[1].replace(".", r"\.") + "$"
    path = F.col("path")
    is_nested = path.rlike(nested)
    rows = listing.where(is_nested | path.rlike(flat)).select(
        F.when(is_nested, F.regexp_extract(path, nested, 2)).otherwise(F.regexp_extract(path, flat, 2)).alias("slide_id"),
        F.when(is_nested, F.regexp_extract(path, nested, 1)).otherwise(F.regexp_extract(path, flat, 1)).alias("model"),
        path, is_nested.cast("int").alias("_rank"))
    return first_per_key(rows, ["slide_id", "model"], [F.col("_rank"), path], last=True).drop("_rank")


def result_listing(spark: SparkSession, results_dir: str, kind: str = "pt") -> DataFrame:
    return parse_results(file_listing(spark, results_dir), kind)


def discover_models(results: DataFrame) -> DataFrame:
    return results.select("model").distinct().orderBy("model")


def latest_snapshot_path(spark: SparkSession, folder: str, prefix: str = "") -> str:
    """Lexicographically last ``<prefix>….parquet`` in the folder, written as a file or as a folder."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "*.parquet").load(folder).select("path"))
    marker = folder.split("://", 1)[-1].strip("/") + "/"
    name = F.substring_index(F.substring_index("path", marker, -1), "/", 1)
    found = listing.where(name.startswith(prefix) & name.endswith(".parquet")).agg(F.max(name)).first()[0]
    if found is None:
        raise FileNotFoundError(f"no {prefix}*.parquet in {folder}")
    return f"{folder.rstrip('/')}/{found}"


def latest_snapshot(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    return spark.read.parquet(latest_snapshot_path(spark, folder, prefix))


def intake_candidates(listing: DataFrame, in_progress: DataFrame | None = None, extensions: Sequence[str] = (),
                      min_bytes: int = 0) -> DataFrame:
    """Files that may enter: allowed type, large enough, settled name, no upload under way (key)."""
    ok = predicates.settled_name(F.col("path")) & predicates.min_size(F.col("length"), min_bytes)
    if extensions:
        ok = ok & predicates.allowed_extension(F.col("path"), extensions)
    rows = listing.where(ok)
    if in_progress is not None:
        rows = rows.join(in_progress.select(F.col("key").alias("path")).distinct(), "path", "left_anti")
    return rows.withColumn("slide_id", text.stem(F.col("path")))


def shard_listing(spark: SparkSession, dest: str) -> DataFrame:
    """(model, path, length) of everything below a shard destination; the model is the first folder."""
    listing = object_listing(spark, dest)
    return listing.where(F.col("key").contains("/")).select(
        F.substring_index("key", "/", 1).alias("model"), F.col("key").alias("path"), "length")
