"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamella.functions import text

# Patterns of the sheets' columns.
SLIDE_PATH_PATTERN = r"^\S+\.(svs|tiff|tif|ndpi|scn)$"
MASK_PATH_PATTERN = r"^\S+\.bmp$"
NO_SPACE_PATTERN = r"^\S+$"


def _any(tests: Sequence[Column]) -> Column:
    return reduce(or_, tests, F.lit(False))


def _listed(spec: str | None) -> list[str] | None:
    """Entries of a comma list; None when the filter is off."""
    if not spec or spec.lower() == "all":
        return None
    return [part.strip() for part in spec.split(",") if part.strip()]


def allowed_extension(path: Column, extensions: Iterable[str]) -> Column:
    return text.extension(path).isin(*[e.lower() for e in extensions])


def min_size(size: Column, limit: int) -> Column:
    return size >= limit


def settled_name(path: Column) -> Column:
    """Neither a partial, a temporary nor a hidden file."""
    name = F.lower(text.basename(path))
    return ~name.rlike(r"\.(part|tmp)$") & ~name.startswith(".")


def slide_type_in(slide_type: Column, spec: str | None, exact: bool = False) -> Column:
    wanted = _listed(spec)
    if wanted is None:
        return F.lit(True)
    return slide_type.isin(*wanted) if exact else _any([slide_type.startswith(w) for w in wanted])


def sample_type_in(sample_type: Column, spec: str | None) -> Column:
    wanted = _listed(spec)
    if wanted is None:
        return F.lit(True)
    return _any([F.lower(sample_type).contains(w.lower()) for w in wanted])


def project_in(project: Column, spec: str | None) -> Column:
    return F.lit(True) if not spec else project.isin(*[p.strip() for p in spec.split(",")])


def readable_source(path: Column, size: Column, min_bytes: int,
                    source: Column | None = None, sources: Sequence[str] = (), extra: str | None = None) -> Column:
    """Path set and large enough, from one of the sources, and any extra SQL predicate."""
    keep = path.isNotNull() & (size >= min_bytes)
    if sources and source is not None:
        keep = keep & source.isin(*sources)
    return keep & F.expr(f"({extra})") if extra else keep


def not_blank(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit("")) != "" for c in columns])


def present_at(first_seen: Column, removed: Column, at: Column) -> Column:
    return (first_seen <= at) & (removed.isNull() | (removed > at))


def active(removed: Column) -> Column:
    return removed.isNull()


def in_models(model: Column, models: Sequence[str] | None) -> Column:
    return F.lit(True) if models is None else model.isin(*models)


def failed_for(status: Column, model: Column, models: Sequence[str] | None) -> Column:
    return (F.lower(status) == "failed") & in_models(F.lower(model), models and [m.lower() for m in models])


def within_retry_budget(fail_count: Column, max_retries: int) -> Column:
    """No limit when ``max_retries`` is 0."""
    return F.lit(True) if max_retries <= 0 else fail_count < max_retries


def finished_before(status: Column, completed_at: Column, now: Column, days: int) -> Column:
    return (status == "SUCCEEDED") & (completed_at < now - F.make_interval(days=F.lit(days)))


def stalled(state: Column, elapsed_s: Column, limit_s: int = 7200) -> Column:
    return (state == "RUNNING") & (elapsed_s > limit_s)


def stuck(status: Column, pid: Column, last_log: Column, now: Column, hours: float) -> Column:
    """Running, with a process, silent for longer than ``hours``; 0 switches it off."""
    if hours <= 0:
        return F.lit(False)
    idle = now.cast("timestamp").cast("double") - last_log.cast("timestamp").cast("double")
    return F.coalesce((status == "RUNNING") & (pid > 0) & (idle > hours * 3600), F.lit(False))


def fresh(modified: Column, now: Column, max_age_hours: float, force: bool = False) -> Column:
    """Younger than the limit; never when forced or when the limit is 0."""
    if force or max_age_hours <= 0:
        return F.lit(False)
    return (now.cast("timestamp").cast("double") - modified.cast("timestamp").cast("double")) < max_age_hours * 3600


def sheet_reasons(slide_id: Column, slide_path: Column) -> Column:
    """Array of the reasons why a sheet row is rejected; empty for a valid row."""
    checks = [
        (~F.coalesce(slide_id.rlike(NO_SPACE_PATTERN), F.lit(False)), "slide_id missing or with spaces"),
        (~F.coalesce(F.lower(slide_path).rlike(SLIDE_PATH_PATTERN), F.lit(False)),
         "slide_path missing, with spaces or of unknown type"),
    ]
    return F.filter(F.array(*[F.when(bad, reason) for bad, reason in checks]), lambda r: r.isNotNull())
