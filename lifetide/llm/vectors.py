"""Fixed-point vectors: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scaled entries are held inside this range, so they fit a long.
LARGEST = float(1 << 62)


def complete(column: str) -> Column:
    """True where the vector and all its entries are there and finite."""
    return F.expr(f"`{column}` IS NOT NULL AND forall(`{column}`, e -> coalesce(abs(cast(e AS double)) < double('Infinity'), false))")


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors of an Arrow list column as doubles, one row each; entries
    that a shorter vector lacks are 0."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dimension).all():
        return flat.reshape(len(lengths), dimension)
    out = np.zeros((len(lengths), dimension))
    at = 0
    for i, n in enumerate(lengths.tolist()):
        out[i, :n] = flat[at : at + n]
        at += n
    return out


def fixed(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * values)`` as doubles that hold integers."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values), -LARGEST, LARGEST)
