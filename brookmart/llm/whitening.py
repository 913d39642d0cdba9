"""Whitening of embeddings on their distinct vectors.

Every entry c becomes the whole number x = floor(64 * c) + 1000000. Rows of equal x
vectors are grouped; each distinct vector has a multiplicity, of which the fit takes
one (``counted``: all). Sums per dimension are exact whole numbers, and rows are
centred in whole numbers before they are multiplied, so the covariance loses nothing
to the large offset: each task adds up one matrix product of its centred rows. The
eigenvectors of the summed matrix, whose size is that of a vector squared, whiten
each distinct vector once, and rows get theirs back by their vector's key.

Rows whose vector is null, or holds a null, a NaN or an infinity, are dropped, empty
vectors have no components. Vectors of different lengths are whitened apart, each
length as a table of its own. Entries beyond 2**46 are taken for it. Components
of no variance (below rounding) are left out, so a single distinct vector gives no
rows. ``deviation`` is null where it exceeds a long; ``deviation_wide`` goes on to 38
digits. Repeated rows and ids give rows each; a null id stays null. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import column, stored
from brookmart.llm.vectors import KEYS, finite, keys, matrices, runs, upper_sums, vectors_of

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 52
#: Sums are kept in two halves of so many bits.
HALF = 26


def _sums(counted: bool):
    """Sums per length and dimension, exact: high and low halves apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        high: dict[int, np.ndarray] = {}
        low: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            values, ends = vectors_of(batch.column(1))
            weight = batch.column(2).to_numpy(zero_copy_only=False) if counted else None
            for a, b in runs(dims):
                d, x = int(dims[a]), values[ends[a]:ends[b]].reshape(b - a, -1)
                w = weight[a:b, None] if counted else 1
                n[d] = n.get(d, 0) + (int(weight[a:b].sum()) if counted else b - a)
                high[d] = high.get(d, 0) + ((x >> HALF) * w).sum(axis=0)
                low[d] = low.get(d, 0) + ((x & ((1 << HALF) - 1)) * w).sum(axis=0)
        for d in n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)),
                 pa.array(np.full(d, n[d], np.int64)), pa.array(high[d]), pa.array(low[d])],
                names=["dims", "i", "n", "high", "low"])
    return run


class Fit:
    """The sums of one length, and its components once they are known."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.floor = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)
        self.vectors: np.ndarray | None = None
        self.values: np.ndarray | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - S) squared, exactly."""
        near = x - self.floor
        most = (float(np.abs(near).max(initial=0)) + 1) * self.n
        if most < 1 << 62 and most * most * x.shape[1] < 1 << 62:
            off = near * self.n - self.rest
            return (off * off).sum(axis=1).tolist()
        off = near.astype(object) * self.n - self.rest.astype(object)
        return (off * off).sum(axis=1).tolist()

    def decompose(self, covariance: np.ndarray, most: int) -> None:
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        real = values > max(values[0], 0) * len(values) * np.finfo(float).eps
        k = min(most, int(real.sum()))
        self.total = float(np.trace(covariance))
        self.values, self.vectors = values[:k], vectors[:, :k]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _whiten(fits):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("dims", pa.int32()), ("n_rows", pa.int64()),
                        ("deviation", pa.int64()), ("deviation_wide", pa.decimal128(38, 0)),
                        ("whitened", pa.list_(pa.float64()))])
    widest = 10 ** 38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            values, ends = vectors_of(batch.column(1))
            for a, b in runs(dims):
                fit = fits.value[int(dims[a])]
                x = values[ends[a]:ends[b]].reshape(b - a, -1)
                far, white = fit.deviations(x), fit.whitened(x)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, white.size + 1, white.shape[1] or 1, dtype=np.int32)
                             if white.shape[1] else np.zeros(b - a + 1, np.int32)), pa.array(white.ravel()))
                some = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [some.column(2), some.column(3), some.column(0), some.column(4),
                     pa.array([f if f < 1 << 63 else None for f in far], pa.int64()),
                     pa.array([Decimal(f) if f < widest else None for f in far], pa.decimal128(38, 0)), lists],
                    schema=schema)
    return run


def distinct_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding"):
    """(rows with their vector's key, stored distinct x vectors with their multiplicity)."""
    c = column(vectors, vec_col).cast("array<double>")
    scaled = F.transform(c, lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(LARGEST))),
                                                         F.lit(-float(LARGEST)))) + OFFSET)
    rows = vectors.filter(finite(c)).select(column(vectors, id_col).cast("long").alias("vec_id"), scaled.alias("x"))
    rows = rows.filter(F.size("x") > 0).select("vec_id", "x", *keys(F.col("x")))
    distinct = rows.groupBy(*KEYS).agg(F.count("*").alias("n_rows"), F.first("x").alias("x"))
    return rows.select("vec_id", *KEYS), stored(
        distinct.select(F.size("x").alias("dims"), "x", *KEYS, "n_rows"), "distinct")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS, counted: bool = False) -> DataFrame:
    """One row per row and component: its whitened coordinate, and figures of the fit.

    ``counted`` fits on all rows (weights are the multiplicities), else every
    distinct vector counts once.
    """
    spark = vectors.sparkSession
    rows, distinct = distinct_vectors(vectors, id_col, vec_col)
    sums = distinct.select("dims", "x", "n_rows").mapInArrow(
        _sums(counted), "dims int, i int, n long, high long, low long").groupBy("dims", "i").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    # a row for each length and dimension
    found: dict[int, list] = {}
    for r in sums.orderBy("dims", "i").collect():
        found.setdefault(r.dims, []).append(r)
    fits = {d: Fit(s[0].n, [(int(r.high) << HALF) + int(r.low) for r in s]) for d, s in found.items()}

    def product(given, of):
        sent = spark.sparkContext.broadcast(fits)

        def part(rows: np.ndarray, d: int) -> np.ndarray:
            z = of(sent.value[d], rows)
            if not counted:
                return z.T @ z
            # the last entry of a row is its multiplicity
            return (z * rows[:, -1:]).T @ z
        return {d: m / fits[d].n for d, m in matrices(upper_sums(given, part)).items()}

    def with_count(vector: str, df: DataFrame) -> DataFrame:
        return df.select("dims", F.concat(vector, F.array("n_rows")).alias("v") if counted else vector)

    cut = (lambda rows: rows[:, :-1]) if counted else (lambda rows: rows)
    for d, v in product(with_count("x", distinct), lambda fit, rows: fit.centred(cut(rows))).items():
        fits[d].decompose(v, components)
    white = stored(distinct.mapInArrow(_whiten(spark.sparkContext.broadcast(fits)), (
        "h1 long, h2 long, dims int, n_rows long, deviation long, deviation_wide decimal(38,0), "
        "whitened array<double>")), "whitened")

    # the covariance of what was made: its means first, then the centred products
    means = {d: np.zeros(len(f.values)) for d, f in fits.items()}
    weight = F.col("n_rows") if counted else F.lit(1)
    for r in white.select("dims", weight.alias("w"), F.posexplode("whitened").alias("i", "v")).groupBy(
            "dims", "i").agg(F.sum(F.col("v") * F.col("w")).alias("s")).collect():
        means[r.dims][r.i] = r.s / fits[r.dims].n
    made = white.filter(F.size("whitened") > 0)
    errors = {d: float(np.abs(m - np.eye(len(m))).max()) for d, m in product(
        with_count("whitened", made), lambda fit, rows: cut(rows) - means[len(fit.floor)]).items()}
    figures = [(d, k + 1, f.n, float(e / f.total), errors[d])
               for d, f in fits.items() for k, e in enumerate(f.values)]
    figures = spark.createDataFrame(
        figures, "dims int, component int, n long, explained double, identity_error double")
    each = rows.join(white, list(KEYS)).select(
        "vec_id", "dims", "n_rows", "deviation", "deviation_wide", F.posexplode("whitened").alias("at", "whitened"))
    return each.withColumn("component", F.col("at") + 1).join(figures, ["dims", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide", "n_rows")

