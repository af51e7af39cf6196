"""Storage precisions of feature vectors, as Arrow-batched functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PRECISIONS = ("float32", "float16", "bfloat16")


def bfloat16_bits(values: np.ndarray) -> np.ndarray:
    """Upper 16 bits of float32, rounded to nearest even; NaN stays NaN."""
    bits = np.ascontiguousarray(values, dtype=np.float32).view(np.uint32)
    rounded = ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16).astype(np.uint16)
    quiet_nan = ((bits >> 16) | 0x0040).astype(np.uint16)
    return np.where(np.isnan(values), quiet_nan, rounded)


def bfloat16_values(bits: np.ndarray) -> np.ndarray:
    return (np.asarray(bits, dtype=np.uint32) << 16).astype(np.uint32).view(np.float32)


def round_to(values: np.ndarray, precision: str) -> np.ndarray:
    """float32 values after a round trip through ``precision``; unknown names change nothing."""
    values = np.asarray(values, dtype=np.float32)
    if precision == "float16":
        with np.errstate(over="ignore"):
            return values.astype(np.float16).astype(np.float32)
    if precision == "bfloat16":
        return bfloat16_values(bfloat16_bits(values))
    return values


def _by_row(batch: pd.Series, change) -> pd.Series:
    """Apply ``change`` to all values of the batch at once, then cut the rows apart again; NULL stays NULL."""
    out = np.empty(len(batch), dtype=object)
    at = np.flatnonzero(batch.notna().to_numpy())
    if len(at):
        rows = batch.iloc[at].to_list()
        flat = change(np.concatenate(rows))
        for i, part in zip(at, np.split(flat, np.cumsum([len(r) for r in rows])[:-1])):
            out[i] = part
    return pd.Series(out, index=batch.index)


def cast_precision(features: Column, target: str) -> Column:
    """Round an ARRAY<FLOAT> to ``target``; the column stays ARRAY<FLOAT>."""
    if target not in PRECISIONS or target == "float32":
        return features

    @F.pandas_udf("array<float>")
    def rounded(batch: pd.Series) -> pd.Series:
        return _by_row(batch, lambda flat: round_to(flat, target))

    return rounded(features)


def cast_to(features: Column, target: Column) -> Column:
    """As ``cast_precision`` with the target per row."""

    @F.pandas_udf("array<float>")
    def rounded(batch: pd.Series, wanted: pd.Series) -> pd.Series:
        out = batch.to_numpy(dtype=object, copy=True)
        for precision in ("float16", "bfloat16"):
            at = np.flatnonzero((wanted == precision).to_numpy())
            if len(at):
                out[at] = _by_row(batch.iloc[at], lambda flat, p=precision: round_to(flat, p)).to_numpy()
        return pd.Series(out, index=batch.index)

    return rounded(features, target)


def bfloat16_encode(features: Column) -> Column:
    """Raw bfloat16 bits as whole numbers (0..65535)."""

    @F.pandas_udf("array<int>")
    def encoded(batch: pd.Series) -> pd.Series:
        return _by_row(batch, lambda flat: bfloat16_bits(np.asarray(flat, np.float32)).astype(np.int32))

    return encoded(features)


def bfloat16_decode(bits: Column) -> Column:
    @F.pandas_udf("array<float>")
    def decoded(batch: pd.Series) -> pd.Series:
        return _by_row(batch, bfloat16_values)

    return decoded(bits)
