"""Registry of the queries: a Spark function over the tables and, where plain SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Tables:
    """The input tables of one folder, read lazily by name."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(tables)`` under its own name."""
    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn
    return register


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def ts(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def day(c: Column) -> Column:
    """Dates leave the queries as text, so that both engines print them alike."""
    return F.date_format(c, "yyyy-MM-dd")


def second(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def hash_sql(*keys: str, seed: int = 0) -> str:
    """SQL text of ``functions.numeric.portable_hash``."""
    h = str(seed % 4294967296)
    for key in keys:
        h = f"((({h}) + ({key}) % 4294967296) * 747796405) % 4294967296"
        h = f"((({h}) + ({h}) // 65536) * 1540483477) % 4294967296"
    return f"({h})"
