"""Vectors as arrays of integers, in tables and in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(embedding: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(vectors: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``values``, floor(scale * x) of each component, of the vectors that are whole."""
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return vectors.where(whole(F.col(embedding))).select(F.col(vec_id).alias("vec_id"), scaled.alias("values"))


def matrix(lists: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of ``dims`` numbers each as the rows of a matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dims)
