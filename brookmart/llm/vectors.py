"""Helpers for operators on tables of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two hashes of different seeds are the key of a vector: 128 bits.
KEYS = ("h1", "h2")


def finite(vector: Column) -> Column:
    """Whether a vector is there, and all its entries are numbers; an empty one is."""
    there = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & there, F.lit(False))


def keys(*columns: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), *columns).alias(n) for i, n in enumerate(KEYS)]


def vectors_of(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a list column without nulls, as doubles or longs, and where each list ends."""
    offsets = column.offsets.to_numpy()
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    return values, (offsets - offsets[0]).astype(np.int64)


def runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last + 1 place of the runs of rows that are equal in all columns."""
    n = len(columns[0])
    if not n:
        return
    new = np.zeros(n - 1, bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    yield from zip(edges, edges[1:])


def upper_sums(df: DataFrame, part) -> DataFrame:
    """(dims, i, j, v): sums of the upper triangles that ``part`` gives for some vectors of equal length.

    ``df`` has (dims, vector); ``part(rows)`` returns a square matrix. Tasks send a
    triangle for each length, whatever their number of rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            values, ends = vectors_of(batch.column(1))
            for a, b in runs(dims):
                rows = values[ends[a]:ends[b]].reshape(b - a, -1)
                d = int(dims[a])
                sums[d] = sums.get(d, 0) + part(rows, d)
        for d, m in sums.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(m[i, j])], names=["dims", "i", "j", "v"])
    return df.mapInArrow(run, "dims int, i int, j int, v double").groupBy("dims", "i", "j").agg(F.sum("v").alias("v"))


def matrices(sums: DataFrame) -> dict[int, np.ndarray]:
    """The symmetric matrix of each length; its size has nothing to do with the number of rows."""
    t = sums.toArrow()
    dims, i, j, v = (t.column(n).to_numpy() for n in ("dims", "i", "j", "v"))
    out = {}
    for d in np.unique(dims).tolist():
        some = dims == d
        size = int(i[some].max()) + 1
        m = np.zeros((size, size))
        m[i[some], j[some]] = m[j[some], i[some]] = v[some]
        out[d] = m
    return out
