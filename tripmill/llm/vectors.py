"""Vectors of a table as numpy blocks, for the operators on embeddings."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(
        vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(good(x), F.lit(False)))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def dump(**arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def load(raw: pa.Scalar) -> dict:
    return pickle.loads(raw.as_buffer())


def blocks(vectors: DataFrame, keys: list[str], block: str, extra: list[str] | None = None) -> DataFrame:
    """One row per group of ``keys`` and ``block``: (keys, block, data) with its ids and vectors.

    ``vectors`` has id, vector, the keys and the block; the caller bounds the rows of a block.
    """
    extra = extra or []
    types = dict(vectors.dtypes)

    def gather(group: pa.Table) -> pa.Table:
        own = {c: group.column(c).to_numpy() for c in ["id", *extra]}
        order = np.argsort(own["id"], kind="stable")
        data = dump(vectors=matrix(group.column("vector"))[order], **{c: v[order] for c, v in own.items()})
        return pa.table({**{c: group.column(c).slice(0, 1) for c in [*keys, block]}, "data": pa.array([data], pa.binary())})

    schema = ", ".join(f"{c} {types[c]}" for c in [*keys, block])
    return vectors.select(*keys, block, "id", "vector", *extra).groupBy(*keys, block).applyInArrow(
        gather, schema + ", data binary")
