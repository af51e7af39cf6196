"""Batch sheets and batch numbering."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import predicates, text
from lamella.operators.ordered import first_per_key, greedy_segments, with_row_number


def one_row_per_slide(rows: DataFrame, arrival: str) -> DataFrame:
    """First arrival per slide id, but a real path wins over a download URI."""
    is_uri = F.coalesce(F.col("slide_path").startswith(text.DOWNLOAD_SCHEME), F.lit(False))
    return first_per_key(rows, ["slide_id"], [is_uri, F.col(arrival)])


def batch_sheet(rows: DataFrame, arrival: str) -> DataFrame:
    """Rows of a batch sheet: deduplicated, with a path, download fields filled from the URI.

    The download columns are always there (nullable); rows that need a download
    but have no file id are dropped.
    """
    once = one_row_per_slide(rows, arrival).where(predicates.not_blank(F.col("slide_path")))
    file_id, file_name = text.fill_from_uri(F.col("slide_path"), F.col("file_id"), F.col("file_name"))
    needs = F.coalesce(F.col("needs_download"), F.lit(False))
    sheet = once.withColumns({"file_id": file_id, "file_name": file_name, "needs_download": needs,
                              "oncotree_code": text.null_to_blank(F.col("oncotree_code"))})
    return sheet.where(~F.col("needs_download") | predicates.not_blank(F.col("file_id"))).select(
        "slide_id", "slide_path", "oncotree_code", "needs_download", "file_id", "file_name")


def with_sample_sizes(rows: DataFrame, key: str = "sample_id", name: str = "n_slides") -> DataFrame:
    """Rows with the size of their sample.

    An aggregate joined back instead of a window: counts combine before the
    shuffle, and the join of a hot sample can be split or broadcast.
    """
    return rows.join(rows.groupBy(key).agg(F.count("*").alias(name)), key, "left")


def multi_slide(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("n_slides") > 1)


def collate(rows: DataFrame, order: Sequence[str], size: int, by: Sequence[str] = (),
            name: str = "batch_no") -> DataFrame:
    """Consecutive batches of ``size`` in the given (unique) order; the last one may be smaller."""
    numbered = with_row_number(rows, by, order, name)
    return numbered.withColumn(name, F.floor((F.col(name) - 1) / size).cast("bigint"))


def rotating_batches(rows: DataFrame, order: Sequence[str], sizes: Sequence[int], min_size: int = 1,
                     name: str = "batch_no") -> DataFrame:
    """Consecutive batches whose sizes rotate through ``sizes``.

    Rows of a last, unfilled batch smaller than ``min_size`` are held back (NULL).
    """
    cycle, ends = sum(sizes), list(accumulate(sizes))
    numbered = with_row_number(rows, [], order, "_rn")
    at = (F.col("_rn") - 1) % cycle
    slot = F.lit(len(sizes) - 1)
    for i in range(len(ends) - 2, -1, -1):
        slot = F.when(at < ends[i], F.lit(i)).otherwise(slot)
    batch = (F.floor((F.col("_rn") - 1) / cycle) * len(sizes) + slot).cast("bigint")
    batched = numbered.withColumn(name, batch)
    if min_size > 1:
        short = batched.groupBy(name).agg(F.count("*").alias("_n")).where(F.col("_n") < min_size)
        full = F.array(*[F.lit(s) for s in sizes])[(F.col(name) % len(sizes)).cast("int")]
        short = short.where(F.col("_n") < full).select(name, F.lit(True).alias("_short"))
        batched = batched.join(short, name, "left").withColumn(name, F.when(F.col("_short").isNull(), F.col(name)))
    return batched.select(*rows.columns, name)


def size_or_time_batches(arrivals: DataFrame, arrived_at: str, unique_id: str, size: int, max_wait_s: float,
                         by: Sequence[str] = (), name: str = "batch_no") -> DataFrame:
    """Batches over an arrival log: closed when full or ``max_wait_s`` after their first arrival."""
    timed = arrivals.withColumn("_one", F.lit(1)).withColumn(
        "_at", F.unix_micros(F.col(arrived_at).cast("timestamp")) / F.lit(1e6))
    out = greedy_segments(timed, by, [arrived_at, unique_id], "_one", size, "_at", max_wait_s, name=name)
    return out.select(*arrivals.columns, name)


def transpose(batches: DataFrame, lists: Sequence[str]) -> DataFrame:
    """Rows of parallel list columns: the i-th entries of all lists make one row."""
    rest = [c for c in batches.columns if c not in lists]
    return batches.select(*rest, F.explode(F.arrays_zip(*lists)).alias("_z")).select(*rest, "_z.*")


def attach_metadata(outputs: DataFrame, meta: DataFrame) -> DataFrame:
    """Outputs matched to their slides by id; outputs of unknown slides are dropped."""
    return outputs.join(meta, "slide_id")
