"""Which shard each slide goes to, the shard index and the entries of the shard manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import text
from lamella.operators.ordered import first_per_key, greedy_segments, with_row_number

DEFAULT_MAX_BYTES = 2_000_000_000
DEFAULT_MAX_SLIDES = 1000
NAME_WIDTH = 6


def shard_name(number: Column, width: Column | int = NAME_WIDTH, prefix: str = "") -> Column:
    digits = number.cast("string")
    padding = F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(width) - F.length(digits)).cast("int"))
    return F.concat(F.lit(prefix), padding, digits, F.lit(".tar"))


def shard_number(name: Column) -> Column:
    """Number of a shard file name, also of a continued one; NULL when the stem is not a number."""
    return F.regexp_extract(text.basename(name), r"^(\d+)(?:\.r\d+)?\.tar$", 1).try_cast("bigint")


def shard_revision(name: Column) -> Column:
    """How often a shard was continued: ``000004.r2.tar`` holds all of ``000004.r1.tar``, and that all of ``000004.tar``."""
    return F.coalesce(F.regexp_extract(text.basename(name), r"\.r(\d+)\.tar$", 1).try_cast("int"), F.lit(0))


def continued_name(name: Column) -> Column:
    """File name of the next revision of a shard."""
    stem = F.regexp_replace(name, r"(?:\.r\d+)?\.tar$", "")
    return F.concat(stem, F.lit(".r"), (shard_revision(name) + 1).cast("string"), F.lit(".tar"))


def superseded(existing: DataFrame, by: Sequence[str]) -> DataFrame:
    """Shard files of which a later revision exists; they may go once no reader follows an index that names them."""
    rows = existing.withColumns({"_no": shard_number(F.col("shard_file")), "_rev": shard_revision(F.col("shard_file"))})
    newest = rows.groupBy(*by, "_no").agg(F.max("_rev").alias("_last"))
    return rows.join(newest, [*by, "_no"]).where("_rev < _last").select(*existing.columns)


def next_shard(existing: DataFrame, by: Sequence[str], name: str = "shard_file") -> DataFrame:
    """Number after the highest existing shard per group; other file names are ignored."""
    highest = F.max(shard_number(F.col(name)))
    return existing.groupBy(*by).agg((F.coalesce(highest, F.lit(-1)) + 1).alias("next_segment"))


def open_shard(existing: DataFrame, by: Sequence[str], cap: int) -> DataFrame:
    """Per group the shard to continue: the last one while below the cap (its file is ``base_file``), else a fresh number.

    ``existing``: the group columns, shard_file and length.
    """
    last = existing.withColumns({"_no": shard_number(F.col("shard_file")), "_rev": shard_revision(F.col("shard_file"))}).where(F.col("_no").isNotNull())
    top = last.groupBy(*by).agg(F.max(F.struct("_no", "_rev", "length", "shard_file")).alias("_top"))
    unsealed = F.col("_top.length") < cap
    return top.select(*by, F.when(unsealed, F.col("_top._no")).otherwise(F.col("_top._no") + 1).alias("next_segment"),
                      F.when(unsealed, F.col("_top.length").cast("double")).alias("filled"),
                      F.when(unsealed, text.basename(F.col("_top.shard_file"))).alias("base_file"))


def continue_shards(assigned: DataFrame, opened: DataFrame, by: Sequence[str]) -> DataFrame:
    """Assignments whose shard is an open one get the name of its next revision."""
    base = opened.where(F.col("base_file").isNotNull()).select(*by, F.col("next_segment").alias("shard"), "base_file")
    joined = assigned.join(base, [*by, "shard"], "left")
    name = F.coalesce(continued_name(F.col("base_file")), F.col("shard_file"))
    return joined.withColumn("shard_file", name).select(*assigned.columns)


def follow_continued(index: DataFrame, assigned: DataFrame, model: str) -> DataFrame:
    """Index rows of a continued shard name the file that now holds them."""
    path = F.concat_ws("/", "project_id", "shard_file")
    now = assigned.where(shard_revision(F.col("shard_file")) > 0).select(
        F.lit(model).alias("model"), "project_id", shard_number(F.col("shard_file")).alias("_no"), path.alias("_now")).distinct()
    moved = index.withColumn("_no", shard_number(F.col("shard_file"))).join(now, ["model", "project_id", "_no"], "left")
    return moved.withColumn("shard_file", F.coalesce("_now", "shard_file")).select(*index.columns)


def assign_by_count(slides: DataFrame, by: Sequence[str], order: Sequence[str], cap: int = DEFAULT_MAX_SLIDES,
                    first: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Shards of at most ``cap`` slides per group, numbered from 0 or from ``first`` (``next_segment``)."""
    numbered = with_row_number(slides, by, order, "_rn")
    sizes = slides.groupBy(*by).agg(F.count("*").alias("_n"))
    if first is not None:
        sizes = sizes.join(first.select(*by, "next_segment"), list(by), "left")
        start = F.coalesce(F.col("next_segment"), F.lit(0))
    else:
        start = F.lit(0)
    last = start + F.ceil(F.col("_n") / cap) - 1
    sizes = sizes.select(*by, start.alias("_start"),
                         F.greatest(F.lit(NAME_WIDTH), F.length(last.cast("string"))).alias("_width"))
    number = (F.col("_start") + F.floor((F.col("_rn") - 1) / cap)).cast("bigint")
    return (numbered.join(sizes, list(by), "left").withColumn("shard", number)
            .withColumn("shard_file", shard_name(F.col("shard"), F.col("_width"), prefix))
            .select(*slides.columns, "shard", "shard_file"))


def assign_by_bytes(slides: DataFrame, by: Sequence[str], order: Sequence[str], size: str,
                    cap: int = DEFAULT_MAX_BYTES, opened: DataFrame | None = None) -> DataFrame:
    """Shards filled in order up to ``cap`` bytes; works on metadata only, payloads are joined later.

    Array bytes count on both sides of the comparison.
    """
    packed = greedy_segments(slides, by, order, size, cap, opened=opened, name="shard")
    return packed.withColumn("shard_file", shard_name(F.col("shard")))


def prune_index(index: DataFrame, failed: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Drop failed slides from the index, but only those of the current batch when one is given."""
    scope = failed.select("slide_id").distinct()
    if batch is not None:
        scope = scope.join(batch.select("slide_id"), "slide_id", "left_semi")
    return index.join(scope, "slide_id", "left_anti")


def plan_append(found: DataFrame, index: DataFrame, routing: DataFrame, model: str,
                batch: DataFrame | None = None, failed: DataFrame | None = None) -> DataFrame:
    """Fate of every result file of a model: append, indexed (skip) or no_group, with its ``project_id``.

    Only files of the batch count when one is given; failed slides are left out.
    """
    files = found
    if batch is not None:
        files = files.join(batch.select("slide_id").distinct(), "slide_id", "left_semi")
    if failed is not None:
        files = files.join(failed.select("slide_id").distinct(), "slide_id", "left_anti")
    known = index.where(F.col("model") == model).select("slide_id").distinct().withColumn("_known", F.lit(True))
    group = routing.groupBy("slide_id").agg(F.max(F.trim("project_id")).alias("project_id"))
    routed = files.join(known, "slide_id", "left").join(group, "slide_id", "left")
    fate = (F.when(F.col("_known"), "indexed")
            .when(F.coalesce(F.col("project_id"), F.lit("")) == "", "no_group").otherwise("append"))
    return routed.withColumn("fate", fate).drop("_known")


def run_summary(planned: DataFrame) -> DataFrame:
    return planned.agg(F.count_if(F.col("fate") == "append").alias("n_appended"),
                       F.count_if(F.col("fate") == "indexed").alias("n_skipped"),
                       F.count_if(F.col("fate") == "no_group").alias("n_missing_group"))


def extend_index(index: DataFrame, assigned: DataFrame, model: str, meta: DataFrame) -> DataFrame:
    """Index with the newly assigned slides; ``shard_file`` carries its group folder."""
    pixel = meta.select("slide_id", "native_mpp", "mpp_is_fallback")
    rows = assigned.join(pixel, "slide_id", "left").select(
        F.lit(model).alias("model"), "slide_id", "project_id",
        F.concat_ws("/", "project_id", "shard_file").alias("shard_file"), "native_mpp", "mpp_is_fallback")
    return index.unionByName(rows)


def manifest_entries(index: DataFrame, new_slides: DataFrame, dest: str, batch: DataFrame | None = None) -> DataFrame:
    """Entries to append to the shard manifest: new slides and slides of this batch already indexed."""
    wanted = new_slides.select("slide_id")
    if batch is not None:
        wanted = wanted.unionByName(batch.select("slide_id"))
    listed = index.join(wanted.distinct(), "slide_id", "left_semi")
    return listed.select("slide_id", "model",
                         F.concat_ws("/", F.lit(dest.rstrip("/")), "model", "shard_file").alias("wds_path"))


def route_from_inventory(inventory: DataFrame) -> DataFrame:
    slide = text.slide_id_from_filename(F.col("file_name")).alias("slide_id")
    return first_per_key(inventory.select(slide, "project_id"), ["slide_id"], [F.col("project_id")], last=True)


def route_from_sheet(sheet: DataFrame, column: str) -> DataFrame:
    """Routing key from a named column of a batch sheet."""
    if column not in sheet.columns or "slide_id" not in sheet.columns:
        raise ValueError(f"the sheet needs the columns slide_id and {column}")
    return sheet.select("slide_id", F.trim(column).alias("project_id")).where(F.col("project_id") != "")
