"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import posixpath
import sys
import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "lamella", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder: on a cluster that folder would exist on one
    machine and be lost with it.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root is None:
        if context.getCheckpointDir() is not None:
            return context.getCheckpointDir()
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written rows.

    Used where a later job must see exactly the same rows in the same partitions
    as an earlier one (range partition numbers), also after a lost executor.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint root for tables written by a job."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package() -> None:
    """Let functions of this package travel to Python workers whole, so that none has to have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules["lamella"])


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI, also of the short form ``file:/…`` that Spark lists."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else posixpath.abspath(path))
