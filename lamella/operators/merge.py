"""Merging a source frame into a target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators.ordered import first_per_key


def latest_per_key(rows: DataFrame, keys: Sequence[str], at: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest row per key, NULL times last."""
    return first_per_key(rows, keys, [F.col(at), *[F.col(t) for t in tiebreak]], last=True)


def add_missing_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the source-only columns added as NULL."""
    return target.unionByName(source.limit(0), allowMissingColumns=True)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], delete_missing: bool = True,
          evolve: bool = True) -> DataFrame:
    """Next version of the target as one full outer join.

    Matched rows take every column the source has; target-only columns keep their
    value on update and are NULL on insert. With ``evolve`` source-only columns
    are added, otherwise left out. Unmatched target rows go or stay. Of source rows
    with one key the largest (column by column) counts, so that no row multiplies;
    ``latest_per_key`` picks by another rule before.
    """
    rest = [c for c in source.columns if c not in keys]
    if rest:
        source = source.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(
            *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in source.columns])
    else:
        source = source.distinct()
    columns = target.columns + ([c for c in source.columns if c not in target.columns] if evolve else [])
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("_in_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys and c in columns],
                      F.lit(True).alias("_in_s"))
    joined = t.join(s, list(keys), "right" if delete_missing else "full_outer")

    def value(c: str):
        if c in keys:
            return F.col(c)
        if c not in source.columns:
            return F.col(f"_t_{c}").alias(c)
        if c not in target.columns or delete_missing:
            return F.col(f"_s_{c}").alias(c)
        return F.when(F.col("_in_s"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)

    return joined.select(*[value(c) for c in columns])


def supports_merge(spark: SparkSession, table: str) -> bool:
    """Whether the table's format has row-level MERGE."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.lower("col_name") == "provider").take(1)
    return bool(rows) and rows[0].data_type.lower() in {"delta", "iceberg", "hudi"}


def merge_into(source: DataFrame, table: str, keys: Sequence[str], delete_missing: bool = True, evolve: bool = True) -> None:
    """Row-level MERGE through the catalog. With ``evolve`` source-only columns are added to the table; otherwise only the
    columns both sides have are set, and target-only ones keep their value on update and are NULL on insert."""
    spark = source.sparkSession
    target = spark.table(table)
    extra = [c for c in source.columns if c not in target.columns]
    if evolve:
        for name in extra:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {source.schema[name].dataType.simpleString()})")
    else:
        source = source.drop(*extra)
    condition = None
    for k in keys:
        same = F.expr(f"{table}.{k} = _source.{k}")
        condition = same if condition is None else condition & same
    values = {c: F.col(f"_source.{c}") for c in source.columns}
    writer = (source.alias("_source").mergeInto(table, condition)
              .whenMatched().update(values).whenNotMatched().insert(values))
    (writer.whenNotMatchedBySource().delete() if delete_missing else writer).merge()


def create_like(source: DataFrame, table: str) -> None:
    """Create the table with the source's columns and no rows, if it does not exist."""
    if not source.sparkSession.catalog.tableExists(table):
        source.limit(0).write.saveAsTable(table)


def audit_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target row counts as one row."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = source.select(one.alias("s"), zero.alias("t")).unionAll(target.select(zero.alias("s"), one.alias("t")))
    return both.agg(F.coalesce(F.sum("s"), zero).alias("source_rows"), F.coalesce(F.sum("t"), zero).alias("target_rows"))
