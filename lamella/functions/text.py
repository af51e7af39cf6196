"""Names, paths, URIs, ids and scheduler text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats the exchanged texts use.
DOWNLOAD_SCHEME = "gdc://"
SLIDE_TYPE_PATTERN = r"-([A-Z]{2}\d+)\."
BATCH_ID_PATTERN = r"batch_(\d{8}T\d{6}_[0-9a-f]+)"
BATCH_ID_TIME_FORMAT = "yyyyMMdd'T'HHmmss"
JOB_PREFIX = "nf-"
ANSI_PATTERN = r"\x1b\[[0-9;]*[mABCDEFGHJKSTfnsuhl]|\r"
PROGRESS_MARK = "executor >"
PRECISION_SUFFIX_PATTERN = r"_(b?float16)$"


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def slide_id_from_filename(file_name: Column) -> Column:
    """Text before the first dot; a bare barcode stays as it is."""
    return F.substring_index(file_name, ".", 1)


def slide_type(file_name: Column) -> Column:
    """Two capitals and digits between a dash and a dot, else ''."""
    return F.regexp_extract(file_name, SLIDE_TYPE_PATTERN, 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot; names such as '.hidden' have none."""
    return F.lower(F.regexp_extract(basename(path), r"[^.](\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def candidate_uri(base: str, file_id: Column, file_name: Column) -> Column:
    return F.concat_ws("/", F.lit(base.rstrip("/")), file_id, file_name)


def download_key(file_id: Column, file_name: Column) -> Column:
    return F.concat(F.lit(DOWNLOAD_SCHEME), file_id, F.lit("/"), file_name)


def parse_download_uri(path: Column) -> tuple[Column, Column]:
    """(file_id, file_name) of a download URI; NULL for any other path."""
    pattern = "^" + DOWNLOAD_SCHEME + "([^/]+)/(.*)$"
    return tuple(F.when(path.rlike(pattern), F.regexp_extract(path, pattern, i)) for i in (1, 2))


def fill_from_uri(path: Column, file_id: Column, file_name: Column) -> tuple[Column, Column]:
    """Take both fields from the URI, only where the file id is missing."""
    missing = F.coalesce(file_id, F.lit("")) == ""
    uri_id, uri_name = parse_download_uri(path)
    return (F.when(missing, F.coalesce(uri_id, file_id)).otherwise(file_id),
            F.when(missing, F.coalesce(uri_name, file_name)).otherwise(file_name))


def split_uri(uri: Column) -> tuple[Column, Column, Column]:
    """(scheme, bucket or host, key) of ``scheme://bucket/key``."""
    pattern = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$"
    return tuple(F.when(uri.rlike(pattern), F.regexp_extract(uri, pattern, i)) for i in (1, 2, 3))


def batch_time(batch_id: Column) -> Column:
    """Creation time coded in a batch id; NULL when it does not parse."""
    return F.try_to_timestamp(F.substring(batch_id, 1, 15), F.lit(BATCH_ID_TIME_FORMAT))


def batch_age_hours(batch_id: Column, now: Column) -> Column:
    return (now.cast("timestamp").cast("double") - batch_time(batch_id).cast("double")) / 3600


def is_stale_batch(batch_id: Column, now: Column, limit_hours: float = 24) -> Column:
    return F.coalesce(batch_age_hours(batch_id, now) > limit_hours, F.lit(False))


def elapsed_seconds(text: Column) -> Column:
    """Seconds of ``[D-]HH:MM:SS``, ``MM:SS`` or ``SS``; NULL for other text.

    One pattern decides whether the text is valid; its parts are then found by their separators alone.
    """
    clean = F.trim(text)
    dated = F.substring_index(F.concat(F.lit("0-"), clean), "-", -2)
    clock = F.concat(F.lit("0:0:"), F.substring_index(clean, "-", -1))

    def number(part: Column) -> Column:
        return F.coalesce(part.try_cast("bigint"), F.lit(0))

    def place(i: int) -> Column:
        return number(F.substring_index(F.substring_index(clock, ":", -i), ":", 1))

    total = number(F.substring_index(dated, "-", 1)) * 86400 + place(3) * 3600 + place(2) * 60 + place(1)
    return F.when(clean.rlike(r"^(\d+-)?\d+(:\d+){0,2}$"), total)


def batch_id_of_workdir(workdir: Column) -> Column:
    return blank_to_null(F.regexp_extract(workdir, BATCH_ID_PATTERN, 1))


def process_short_name(job_name: Column) -> Column:
    """Job name without its prefix and its trailing task number."""
    return F.regexp_replace(F.regexp_replace(job_name, "^" + JOB_PREFIX, ""), r"\s*\(\d+\)$", "")


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, ANSI_PATTERN, "")


def last_progress_block(text: Column) -> Column:
    """Clean text from the last progress mark on, or all of it."""
    clean = strip_ansi(text)
    tail = F.substring_index(clean, PROGRESS_MARK, -1)
    return F.trim(F.when(clean.contains(PROGRESS_MARK), F.concat(F.lit(PROGRESS_MARK), tail)).otherwise(clean))


def pretty_duration(seconds: Column) -> Column:
    """``1d 2h 3m``, ``2h 3m`` or ``<1m``; NULL stays NULL. ``seconds`` is used several times: give a column, not a long expression."""
    s = F.floor(seconds).cast("bigint")
    minutes, hours, days = F.floor(s / 60) % 60, F.floor(s / 3600) % 24, F.floor(s / 86400)
    return (F.when(s < 60, F.lit("<1m"))
            .when(days > 0, F.format_string("%dd %dh %dm", days, hours, minutes))
            .when(s >= 60, F.format_string("%dh %dm", hours, minutes)))


def table_to_volume(name: Column) -> Column:
    """``a.b.c`` to ``/Volumes/a/b/c``."""
    return F.concat(F.lit("/Volumes/"), F.array_join(F.split(name, r"\."), "/"))


def volume_to_table(path: Column) -> Column:
    """``/Volumes/a/b/c[/...]`` to ``a.b.c``; NULL for other paths."""
    pattern = r"^/Volumes/([^/]+)/([^/]+)/([^/]+)"
    parts = [F.regexp_extract(path, pattern, i) for i in (1, 2, 3)]
    return F.when(path.rlike(pattern), F.concat_ws(".", *parts))


def run_suffix(run_name: Column) -> Column:
    """The part of a run name that ends a batch id: the eight hex digits, or the whole id."""
    short = F.regexp_replace(run_name, "^dispatcher_", "")
    return F.when(short.rlike("^r?[0-9a-f]{8}$"), F.regexp_replace(short, "^r", "")).otherwise(short)


def base_model(model: Column) -> Column:
    return F.regexp_replace(model, PRECISION_SUFFIX_PATTERN, "")


def precision_label(model: Column) -> Column:
    suffix = F.regexp_extract(model, PRECISION_SUFFIX_PATTERN, 1)
    return F.when(suffix != "", suffix).otherwise("float32")


def model_of_feature_path(path: Column) -> Column:
    """First directory below ``features/``, for the flat and the nested layout."""
    return F.regexp_extract(path, r"(?:^|/)features/([^/]+)/", 1)


def manifest_key(path: Column) -> Column:
    """Key under which a result path is listed in a manifest; NULL for other files."""
    return (F.when(path.rlike(r"(^|/)features/.*\.features\.pt$"),
                   F.concat(model_of_feature_path(path), F.lit("_features_tensor_path")))
            .when(path.rlike(r"(^|/)filter_tiles/.*\.patch\.h5$"), F.lit("filtered_tiles_h5_path"))
            .when(path.rlike(r"(^|/)tiles/.*\.patch\.h5$"), F.lit("tiles_h5_path")))


def failure_class(stderr: Column, exit_code: Column, state: Column) -> Column:
    """Why a job failed, from its error text, exit code and final state; first match wins."""
    text = F.lower(F.coalesce(stderr, F.lit("")))
    code = F.substring_index(exit_code.cast("string"), ":", 1).try_cast("int")
    return (F.when(text.contains("cuda out of memory"), "oom_gpu")
            .when((code == 137) | text.contains("oom-kill"), "oom_host")
            .when((code == 143) | state.startswith("CANCEL"), "sigterm")
            .when(text.contains("no space left"), "disk_full")
            .when(text.contains("s3://") & text.rlike("exception|error"), "s3_error")
            .when(text.contains("traceback (most recent call last)"), "python_error")
            .when(state == "TIMEOUT", "timeout")
            .when(code == 1, "error_exit1")
            .otherwise("unknown"))
