"""Keyed tables whose versions rewrite only the buckets they change.

Layout: ``<folder>/__version=<version>/__bucket=<n>/part-…``. A key belongs to one bucket. A
version is an ordinary partitioned write, there as soon as its ``_SUCCESS`` is; it
holds only the buckets it changed, and the table is the newest version of each
bucket. So a change of a few keys costs a few buckets, a failed write is never
seen, and readers of the version before are not disturbed. A bucket without rows
keeps one marker row, which readers leave out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.numeric import portable_hash
from lamella.sources.files import path_exists

BUCKETS = 16
#: A bucket is rewritten by one task, so a large table gets more buckets.
ROWS_PER_BUCKET = 500_000
_LIVE, _BUCKET, _VERSION = "__live", "__bucket", "__version"
Change = Callable[[DataFrame], DataFrame]


def buckets_for(rows: int) -> int:
    """Buckets of a table that will hold about so many rows."""
    return max(BUCKETS, -(-rows // ROWS_PER_BUCKET))


def _children(spark: SparkSession, path: str) -> list[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


class BucketTable:
    """A table with bucketed versions. ``key`` names the column that decides the bucket (the first one if not given).

    The number of buckets is fixed by the first version; a task rewrites one
    bucket, so it should follow from the size of the table (``buckets_for``).
    """

    def __init__(self, spark: SparkSession, folder: str, key: str | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.key, self.buckets = spark, folder.rstrip("/"), key, buckets

    def _folder(self, version: int) -> str:
        return f"{self.folder}/{_VERSION}={version:012d}"

    def committed(self, version: int) -> bool:
        return path_exists(self.spark, f"{self._folder(version)}/_SUCCESS")

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = [re.fullmatch(rf"{_VERSION}=(\d+)", name) for name in _children(self.spark, self.folder)]
        return [v for v in sorted(int(m[1]) for m in found if m) if self.committed(v)]

    def rewritten(self, version: int) -> list[int]:
        """Buckets that a version holds files for."""
        found = [re.fullmatch(rf"{_BUCKET}=(\d+)", name) for name in _children(self.spark, self._folder(version))]
        return sorted(int(m[1]) for m in found if m)

    def places(self, upto: int | None = None) -> dict[int, int]:
        """The newest version of every bucket, of all versions or those up to ``upto``."""
        return {b: v for v in self.versions() if upto is None or v <= upto for b in self.rewritten(v)}

    def read(self, upto: int | None = None, only: Iterable[int] | None = None, versions: bool = False) -> DataFrame:
        """The rows now (or as of a version), of all buckets or some; with ``versions`` also ``version``, the one that wrote each row."""
        places = self.places(upto)
        if not places:
            raise FileNotFoundError(f"no version in {self.folder}")
        newest = max(places.values())
        # Buckets written before a column was added lack it and read it as NULL.
        schema = self.spark.read.parquet(self._folder(newest)).drop(_BUCKET).schema
        chosen = sorted(places) if only is None else sorted(set(only) & set(places))
        paths = [f"{self._folder(places[b])}/{_BUCKET}={b}" for b in chosen]
        if not paths:
            rows = self.spark.createDataFrame([], schema).withColumn(_VERSION, F.lit(0).cast("bigint"))
        else:
            rows = self.spark.read.schema(schema).option("basePath", self.folder).parquet(*paths).withColumn(_VERSION, F.col(_VERSION).cast("bigint"))
        rows = rows.where(_LIVE).drop(_LIVE, _BUCKET)
        return rows.withColumnRenamed(_VERSION, "version") if versions else rows.drop(_VERSION)

    def number(self, rows: DataFrame, buckets: int) -> Column:
        """Bucket of a row; rows without a key are in the first."""
        return F.coalesce(portable_hash(F.col(self.key or rows.columns[0])) % buckets, F.lit(0)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """The first version, with every bucket; does nothing if it is there."""
        if not self.committed(0):
            self._write(rows, 0, range(self.buckets), self.buckets)

    def advance(self, version: int, change: Change, touched: Change | None = None) -> list[int]:
        """Write a version once and return its buckets; a repeated call finds it there and does nothing.

        ``change`` makes the next rows from rows of whole buckets. ``touched`` gives, from
        the table, rows with the keys that may change or appear; then only their buckets are read
        a second time and written. Without it the change is computed for the whole
        table, and the buckets whose rows differ are written.
        """
        if self.committed(version):
            return self.rewritten(version)
        places = self.places(version - 1)
        count, before = len(places), self.read(version - 1)
        if touched is not None:
            keys = touched(before)
            changed = [r[0] for r in keys.select(self.number(keys, count).alias("b")).distinct().collect()]
        else:
            changed = self._different(before, change(before), count)
        part = before if len(changed) == count else self.read(version - 1, changed)
        self._write(change(part), version, changed, count)
        return sorted(changed)

    def _different(self, before: DataFrame, after: DataFrame, count: int) -> list[int]:
        """Buckets whose rows are not the same: by number of rows and two sums of row hashes. At most ``count`` numbers."""
        # A NULL leaves a hash as it is, so a new column without values makes no difference.
        columns = sorted(set(before.columns) | set(after.columns))

        def sums(rows: DataFrame) -> DataFrame:
            own = [F.col(c) if c in rows.columns else F.lit(None) for c in columns]
            nulls = F.concat_ws(",", *[F.when(v.isNotNull(), F.lit(c)) for c, v in zip(columns, own)])
            hashes = [F.xxhash64(*own, nulls, F.lit(salt)).cast("decimal(38,0)") for salt in (1, 2)]
            return rows.groupBy(self.number(rows, count).alias("b")).agg(F.struct(F.count(F.lit(1)), *[F.sum(h) for h in hashes]).alias("s"))
        old, new = sums(before).withColumnRenamed("s", "o"), sums(after)
        return [r[0] for r in old.join(new, "b", "full_outer").where(~F.col("o").eqNullSafe(F.col("s"))).select("b").collect()]

    def _write(self, rows: DataFrame, version: int, changed: Iterable[int], count: int) -> None:
        numbered = rows.withColumns({_LIVE: F.lit(True), _BUCKET: self.number(rows, count)})
        changed = sorted(changed)
        marks = self.spark.createDataFrame([(b,) for b in changed], f"{_BUCKET} int").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields], F.lit(False).alias(_LIVE), _BUCKET)
        if len(changed) < count:
            numbered = numbered.where(F.col(_BUCKET).isin(changed))
        # By the number itself: a hash of it would put several buckets into one task.
        (numbered.unionByName(marks).repartitionById(count, F.col(_BUCKET))
         .write.mode("overwrite").partitionBy(_BUCKET).parquet(self._folder(version)))

    def expire(self, keep: int = 2) -> int:
        """Delete files that none of the last ``keep`` versions reads; how many bucket folders went."""
        versions = self.versions()
        needed = {(b, v) for upto in versions[-keep:] for b, v in self.places(upto).items()}
        gone = [(b, v) for v in versions for b in self.rewritten(v) if (b, v) not in needed]
        for b, v in gone:
            _delete(self.spark, f"{self._folder(v)}/{_BUCKET}={b}")
        return len(gone)
