"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold no null or non-finite component."""
    v = vector.cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of a list column, all of length ``dim``, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def scaled(rows: np.ndarray) -> np.ndarray:
    """The rows, each in units of a power of two, so that their squares stay in the range of doubles; no cosine changes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None])


def packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unpacked(values, dtype) -> np.ndarray:
    return np.array([np.frombuffer(v, dtype) for v in values])


def even(column: pa.Array, dtype) -> np.ndarray:
    """The rows of a binary column without nulls, all of one length, as a matrix, without a step per row."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(column) else np.zeros(0, np.uint8)
    return data.reshape(len(column), -1).view(dtype) if len(column) else data.view(dtype).reshape(0, 1)


def roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches along the links (x, y)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
