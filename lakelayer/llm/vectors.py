"""Integer vectors out of a column of floating-point arrays, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakelayer.llm.common import col

INF = float("inf")


def usable(vec_col: str) -> Column:
    """The vector is there and every component is a finite number (an empty vector is usable)."""
    fine = F.forall(F.transform(col(vec_col), lambda x: x.cast("double")),
                    lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF)))
    return col(vec_col).isNotNull() & F.coalesce(fine, F.lit(False))


def as_doubles(vec_col: str) -> Column:
    return col(vec_col).cast("array<double>")


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list array as float64; shorter rows are filled with zeros up to ``width`` (default: the longest row)."""
    ends = np.asarray(column.offsets).astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lens = np.diff(ends)
    longest = int(lens.max(initial=0))
    width = longest if width is None else max(width, longest)
    if len(lens) and (lens == width).all():
        return flat[ends[0]:ends[-1]].reshape(len(lens), width)
    out = np.zeros((len(lens), width))
    inside = np.arange(width)[None, :] < lens[:, None]
    out[inside] = flat[ends[0]:ends[-1]]
    return out


def quantised(column: pa.Array, scale: int, width: int | None = None) -> np.ndarray:
    """floor(scale * x) of every component, as float64 (exact: ``scale`` is a power of two)."""
    return np.floor(matrix(column, width) * float(scale))


def smallest_ids(df: DataFrame, id_col: str, n: int, *then: str) -> list:
    """The ``n`` rows of smallest id (nulls last, ties by the columns ``then``): at most ``n`` rows reach the driver."""
    return df.orderBy(F.col(id_col).asc_nulls_last(), *then).limit(n).collect()
