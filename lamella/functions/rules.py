"""Configuration rules resolved per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which patch encoder feeds each slide encoder.
SLIDE_TO_PATCH = {
    "gigapath_slide": "gigapath",
    "titan_slide": "conch1_5",
    "prism_slide": "virchow",
    "feather_slide": "conch1_5",
    "chief_slide": "ctranspath",
    "madeleine_slide": "clip",
}
# Artifact class ids each preset removes.
AGGRESSIVE_CLASSES = [2, 3, 4, 5, 6, 7]
PEN_MARK_CLASSES = [4, 7]
# Class names used when a tissue code has none of its own.
DEFAULT_CLASSES = ["invasive carcinoma", "stroma", "other"]


def _lookup(table: Mapping[str, object], key: Column) -> Column:
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.create_map(*entries)[key] if entries else F.lit(None)


def default_sample_id(sample_id: Column, slide_id: Column) -> Column:
    return F.coalesce(F.when(sample_id != "", sample_id), slide_id)


def shard_group(code: Column, by_code: bool) -> Column:
    """The tissue code when grouping is on and a code is set, else 'all'."""
    return F.when(F.lit(by_code) & (code != ""), code).otherwise("all")


def resolve_precision(model: Column, overrides: Mapping[str, str] = {}, default: str | None = None) -> Column:
    return F.coalesce(_lookup(overrides, model).cast("string"), F.lit(default), F.lit("float32"))


def patch_encoder(model: Column) -> Column:
    return F.coalesce(_lookup(SLIDE_TO_PATCH, model), model)


def aggregation_method(model: Column) -> Column:
    """'model' for a slide encoder, 'identity' for a patch encoder."""
    return F.when(model.isin(*SLIDE_TO_PATCH), "model").otherwise("identity")


def resolve_batch_size(model: Column, sizes: Mapping[str, int], default: int = 64) -> Column:
    lowered = {name.lower(): size for name, size in sizes.items()}
    return F.coalesce(_lookup(lowered, F.lower(model)).cast("int"), F.lit(default))


def artifact_classes(explicit: Sequence[int] | None, aggressive: bool, pen_marks: bool) -> list[int]:
    """Class ids to remove: an explicit list wins, then the aggressive preset, then pen marks."""
    if explicit is not None:
        return list(explicit)
    if aggressive:
        return list(AGGRESSIVE_CLASSES)
    return list(PEN_MARK_CLASSES) if pen_marks else []


def failure_reason(status: Column, reason: Column, default: str = "Failed after max retries") -> Column:
    """Reason text of failed rows (a default when blank), '' for every other row."""
    return F.when(status == "FAILED", F.coalesce(F.when(reason != "", reason), F.lit(default))).otherwise("")


def status_rule(result_path: Column, shard_path: Column, failure: Column) -> tuple[Column, Column, Column]:
    """(status, path, reason): a result file wins over a shard entry, that over a failure."""
    has_file, has_shard = result_path.isNotNull(), F.coalesce(shard_path, F.lit("")) != ""
    status = (F.when(has_file | has_shard, "done").when(failure.isNotNull(), "failed").otherwise("pending"))
    path = F.when(has_file, result_path).when(has_shard, shard_path).otherwise("")
    reason = F.when(status == "failed", failure).otherwise("")
    return status, path, reason
