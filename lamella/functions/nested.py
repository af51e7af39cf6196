"""Access into optional nested documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_element(array: Column) -> Column:
    """First entry of an array, NULL when it is empty or missing."""
    return F.get(array, F.lit(0))


def first_value(array: Column, field: str) -> Column:
    """First non-null value of ``field`` over an array of structs."""
    values = F.transform(array, lambda item: item[field])
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))
