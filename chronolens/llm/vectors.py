"""Vectors as integers: floor(scale * component) + shift, for the operators that compute exactly.

Rows whose vector is null, empty, or holds null or non-finite components are left out.
A component of 2**62 or more after scaling is an error, and so are vectors of several lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def integers(vectors: DataFrame, scale: int, shift: int = 0) -> DataFrame:
    """(vec_id, x): x as array<long>."""
    value = F.col("embedding").cast("array<double>")

    def whole(v):
        return F.when(F.abs(v * scale) < float(1 << 62), F.floor(v * scale).cast("long") + shift).otherwise(
            F.raise_error(F.lit("a component does not fit a long")).cast("long"))

    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(True)))
    return kept.select("vec_id", F.transform("v", whole).alias("x"))


def dimension(rows: DataFrame) -> tuple[int, int]:
    """(number of rows, length of their vectors); 0 for no rows."""
    n, least, most = rows.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if n and least != most:
        raise ValueError(f"vectors of several lengths, from {least} to {most}")
    return n, most or 0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as an int64 array."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)
