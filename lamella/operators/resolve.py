"""Which files are still to do, and where each can be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import predicates, text
from lamella.schemas import SAMPLE_COLUMNS


def done_slides(status: DataFrame, models: Sequence[str] | None = None, mode: str = "any") -> DataFrame:
    """Slides to skip: done for 'any' listed model, for the 'first' one only, or for 'all' of them."""
    done = status.where(F.col("status") == "done")
    if models and mode == "first":
        done = done.where(F.col("model") == models[0])
    elif models:
        done = done.where(F.col("model").isin(*models))
    if models and mode == "all":
        return (done.groupBy("slide_id").agg(F.count_distinct("model").alias("_n"))
                .where(F.col("_n") == len(set(models))).select("slide_id"))
    return done.select("slide_id").distinct()


def pending(inventory: DataFrame, done: DataFrame | None = None, slide_types: str | None = None,
            sample_types: str | None = None, projects: str | None = None, exact_type: bool = False,
            limit: int | None = None) -> DataFrame:
    """Inventory rows that pass the filters and are not done; the first ``limit`` by project and slide.

    Filters come before the anti join, and the limit before any path lookup, so
    the lookups see as few rows as possible.
    """
    slides = inventory.withColumn("slide_id", text.slide_id_from_filename(F.col("file_name"))).where(
        (F.col("slide_id") != "")
        & predicates.slide_type_in(F.col("slide_type"), slide_types, exact_type)
        & predicates.sample_type_in(F.col("sample_type"), sample_types)
        & predicates.project_in(F.col("project_id"), projects))
    if done is not None:
        slides = slides.join(done, "slide_id", "left_anti")
    if limit:
        slides = slides.orderBy("project_id", "slide_id", "file_id").limit(limit)
    return slides


def resolve_paths(slides: DataFrame, local: DataFrame | None = None, local_root: str | None = None,
                  remote: DataFrame | None = None, remote_base: str | None = None,
                  unknown_is_present: bool = False) -> DataFrame:
    """Where each slide can be read: local disk, then the object store, else it needs a download.

    ``local``: key, length and ``remote``: key are listings with keys
    ``<file_id>/<file_name>``. A local file of another size than expected is a
    partial download and does not count. Without a ``remote`` listing a candidate
    URI is taken as present; a listing that failed is passed as an empty frame,
    or as None with ``unknown_is_present``.
    """
    keyed = slides.withColumn("_key", F.concat_ws("/", "file_id", "file_name"))
    have_local = have_remote = F.lit(False)
    local_path, candidate = F.lit(""), F.lit(None).cast("string")
    if local_root is not None:
        local_path = F.concat(F.lit(local_root.rstrip("/") + "/"), F.col("_key"))
    if local is not None and local_root is not None:
        found = local.groupBy(F.col("key").alias("_key")).agg(F.max("length").alias("_length"))
        keyed = keyed.join(found, "_key", "left")
        expected = F.coalesce(F.col("file_size"), F.lit(0))
        have_local = F.col("_length").isNotNull() & ((expected == 0) | (F.col("_length") == expected))
    if remote_base is not None:
        candidate = text.candidate_uri(remote_base, F.col("file_id"), F.col("file_name"))
        if remote is not None:
            keys = remote.select(F.col("key").alias("_key")).distinct().withColumn("_remote", F.lit(True))
            keyed = keyed.join(keys, "_key", "left")
            have_remote = F.coalesce(F.col("_remote"), F.lit(unknown_is_present))
        else:
            have_remote = F.lit(True)
    path = F.when(have_local, local_path).when(have_remote, candidate).otherwise(local_path)
    return (keyed.withColumn("slide_path", path)
            .withColumn("needs_download", ~(have_local | have_remote)).select(*SAMPLE_COLUMNS))


def readiness_counts(samples: DataFrame) -> DataFrame:
    return samples.agg(F.count_if(~F.col("needs_download")).alias("n_ready"),
                       F.count_if(F.col("needs_download")).alias("n_needs_download"))


def check_exists(slides: DataFrame, listing: DataFrame | None, scheme: str = "s3") -> DataFrame:
    """Add ``exists``: true or false for paths of the scheme, true for other paths, NULL when unknown."""
    remote = F.col("slide_path").startswith(f"{scheme}://")
    if listing is None:
        return slides.withColumn("exists", F.when(~remote, True))
    known = listing.select(F.col("uri").alias("slide_path")).distinct().withColumn("_found", F.lit(True))
    joined = slides.join(known, "slide_path", "left")
    found = F.when(~remote, True).otherwise(F.coalesce(F.col("_found"), F.lit(False)))
    return joined.withColumn("exists", found).drop("_found")


def split_by_existence(checked: DataFrame, unknown_is_present: bool = True) -> tuple[DataFrame, DataFrame]:
    """(usable, missing) rows of ``check_exists``."""
    present = F.coalesce(F.col("exists"), F.lit(unknown_is_present))
    return checked.where(present), checked.where(~present)


def new_paths(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Candidates whose path is not in the state table."""
    return candidates.join(state.select("slide_path").distinct(), "slide_path", "left_anti")


def admit_downloads(candidates: DataFrame, state: DataFrame, max_retries: int) -> DataFrame:
    """Candidates that may be queued for download under their own key.

    Dropped: rows without file id or name, keys already known, slides done or
    waiting under another kind of path, and slides out of retries. The state is
    first reduced to one row of flags per slide, which combines before the shuffle.
    """
    waiting = F.col("status").isin("PENDING", "DISPATCHED") & ~F.col("slide_path").startswith(text.DOWNLOAD_SCHEME)
    exhausted = (F.col("fail_count") >= max_retries) if max_retries > 0 else F.lit(False)
    blocked = (state.groupBy("slide_id")
               .agg(F.bool_or((F.col("status") == "SUCCEEDED") | waiting | exhausted).alias("_blocked"))
               .where("_blocked").select("slide_id"))
    keyed = (candidates.where(predicates.not_blank(F.col("file_id"), F.col("file_name")))
             .withColumn("slide_path", text.download_key(F.col("file_id"), F.col("file_name"))))
    return new_paths(keyed, state).join(blocked, "slide_id", "left_anti")


def matched(matches: DataFrame, inventory: DataFrame, min_bytes: int, sources: Sequence[str] = (),
            extra: str | None = None) -> DataFrame:
    """(slide_id, slide_path, oncotree_code) of matched images whose file is readable.

    ``matches``: image_id, oncotree_code; ``inventory``: image_id, path, size, source.
    """
    readable = inventory.where(
        predicates.readable_source(F.col("path"), F.col("size"), min_bytes, F.col("source"), sources, extra))
    return matches.join(readable, "image_id").select(
        F.col("image_id").alias("slide_id"), F.col("path").alias("slide_path"), "oncotree_code")
