"""Near copies of embeddings by cosine, within a label, by PCA-ordered tiles.

Equal vectors of a label are one class, with the number of its rows. Classes are
sorted by their leading principal coordinate and cut into tiles. Unit vectors that
are linked are no further apart than ``sqrt(2 - 2 * threshold)``, so two tiles are
compared only if the boxes around their leading coordinates come that close. Inside
a pair of tiles the products of the leading dimensions are summed up first; what is
left of a product is at most the product of the two suffix norms, and a pair is given
up as soon as its cosine cannot reach the threshold. Any orthogonal basis gives the
same links; the one used is of at most ``SAMPLE`` vectors, taken by hash. Products
within rounding of the threshold are decided on the vectors as they came.

A tile is sent to tasks with up to ``AT_ONCE`` others, so what a task holds is
bounded. It returns the number of links of each class and a spanning forest of the
links: never pairs. Work grows with the square of a label's distinct vectors, as far
as boxes overlap; copies do not add to it.

Vectors that are null, empty, zero or hold a null, a NaN or an infinity link with
nothing, nor do those of a null label; vectors of different lengths do not link.
Rows of equal id are vectors of their own; a null id is not the least id of a
component that has others. No rows give none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import column, stored
from brookmart.llm.components import components
from brookmart.llm.vectors import KEYS, finite, keys, runs, vectors_of

THRESHOLD = 0.93
TILE_ROWS = 4096
#: A tile's vectors take no more bytes, as doubles.
TILE_BYTES = 4_000_000
#: Tiles that one tile is compared with in one task.
AT_ONCE = 16
SAMPLE = 2048
#: Leading coordinates of a tile's box, and dimensions summed up at a time.
BOX, STEP = 8, 8
#: Rows of a tile that are multiplied at once.
ROWS = 512
#: Rounding errors of a product of unit vectors are far below this.
NEAR = 1e-9


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one, also of entries whose squares leave the range of doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, of vectors as they are."""
    x = x / np.exp2(np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True))))
    y = y / np.exp2(np.floor(np.log2(np.abs(y).max(axis=1, keepdims=True))))
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def bases(classes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """For each length in a sample, principal directions as columns, the strongest first."""
    share = min(1.0, 4 * sample / max(classes.count(), 1))
    few = classes.filter(F.pmod("h1", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("h1").limit(sample)
    by_length: dict[int, list[np.ndarray]] = {}
    for v in few.select("vec").toArrow().column(0).to_pylist():
        by_length.setdefault(len(v), []).append(np.asarray(v, float))
    out = {}
    for d, rows in by_length.items():
        u = units(np.stack(rows))
        out[d] = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
    return out


def turned(x: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    u = units(x)
    return u if basis is None else u @ basis


def _lead(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ends = vectors_of(batch.column(4))
            dims = np.diff(ends)
            lead = np.empty(batch.num_rows)
            for a, b in runs(dims):
                d = int(dims[a])
                lead[a:b] = turned(values[ends[a]:ends[b]].reshape(b - a, d).astype(float), sent.value.get(d))[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims.astype(np.int32)), pa.array(lead)],
                names=["h1", "h2", "lab", "n", "vec", "dims", "lead"])
    return run


def _tile(sent, tile_rows: int):
    """Adds the tile of each row; a row of its own, without a class, has a tile's box."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, at = TaskContext.get().partitionId() << 32, 0, None
        low = high = np.empty(0)

        def box() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in (
                    (tile, pa.int64()), (None, pa.int64()), (None, pa.int64()), (at[0], pa.int64()),
                    (at[1], pa.int32()), (held, pa.int64()), (None, pa.list_(pa.float64())),
                    (low.tolist(), pa.list_(pa.float64())), (high.tolist(), pa.list_(pa.float64())))],
                names=names)
        names = ["tile", "h1", "h2", "lab", "dims", "n", "vec", "low", "high"]
        for batch in batches:
            lab, dims = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 5))
            values, ends = vectors_of(batch.column(4))
            for a, b in runs(lab, dims):
                d = int(dims[a])
                most = max(1, min(tile_rows, TILE_BYTES // (8 * d)))
                x = turned(values[ends[a]:ends[b]].reshape(b - a, d).astype(float), sent.value.get(d))[:, :BOX]
                while a < b:
                    if at != (int(lab[a]), d) or held >= most:
                        if held:
                            yield box()
                            tile += 1
                        at, held = (int(lab[a]), d), 0
                        low, high = np.full(x.shape[1], np.inf), np.full(x.shape[1], -np.inf)
                    take = min(b - a, most - held)
                    low, high = np.minimum(low, x[:take].min(axis=0)), np.maximum(high, x[:take].max(axis=0))
                    some, none = batch.slice(a, take), pa.nulls(take, pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(take, tile)), some.column(0), some.column(1), some.column(2), some.column(5),
                         some.column(3), some.column(4).cast(pa.list_(pa.float64())), none, none], names=names)
                    held, a, x = held + take, a + take, x[take:]
        if held:
            yield box()
    return run


class Tile:
    """Classes with their vectors, and these turned, with the norms of what follows each step."""

    def __init__(self, cls: np.ndarray, n: np.ndarray, x: np.ndarray, basis: np.ndarray | None):
        self.cls, self.n, self.x = cls, n, x
        self.u = turned(x, basis)
        d = x.shape[1]
        self.steps = [*range(min(STEP, d), d, STEP), d]
        after = np.cumsum((self.u * self.u)[:, ::-1], axis=1)[:, ::-1]
        self.rest = [np.sqrt(after[:, k]) if k < d else np.zeros(len(x)) for k in self.steps]


def linked(one: Tile, other: Tile, begin: int, end: int, same: bool, threshold: float) -> np.ndarray:
    """Which rows of one (from ``begin`` to ``end``) are linked with which of other."""
    u, k = one.u[begin:end], one.steps[0]
    sums = u[:, :k] @ other.u[:, :k].T
    alive = sums + np.outer(one.rest[0][begin:end], other.rest[0]) >= threshold - NEAR
    if same:
        alive &= np.arange(begin, end)[:, None] < np.arange(len(other.cls))
    for s in range(1, len(one.steps)):
        if not alive.any():
            return alive
        a, b = one.steps[s - 1:s + 1]
        rest, more = one.rest[s][begin:end], other.rest[s]
        if alive.mean() > 0.02:
            sums += u[:, a:b] @ other.u[:, a:b].T
            alive &= sums + np.outer(rest, more) >= threshold - NEAR
        else:
            i, j = np.nonzero(alive)
            sums[i, j] += (u[i, a:b] * other.u[j, a:b]).sum(axis=1)
            out = sums[i, j] + rest[i] * more[j] < threshold - NEAR
            alive[i[out], j[out]] = False
    i, j = np.nonzero(alive & (sums < threshold + NEAR))
    if len(i):
        alive[i, j] = cosines(one.x[begin + i], other.x[j]) >= threshold
    return alive


def compare(one: Tile, other: Tile, same: bool, threshold: float):
    """(links of one's classes in rows, links of other's, edges of a spanning forest)."""
    ones, others = np.zeros(len(one.cls)), np.zeros(len(other.cls))
    group = np.arange(len(other.cls))
    edges = []
    for begin in range(0, len(one.cls), ROWS):
        end = min(begin + ROWS, len(one.cls))
        found = linked(one, other, begin, end, same, threshold)
        if not found.any():
            continue
        ones[begin:end] += found @ other.n
        others += one.n[begin:end] @ found
        for i in np.flatnonzero(found.any(axis=1)).tolist():
            met = group[found[i]]
            if same:
                met = np.append(met, group[begin + i])
            first, *rest = np.unique(met).tolist()
            edges += [(one.cls[begin + i], other.cls[g]) for g in (first, *rest)]
            if rest:
                group[np.isin(group, rest)] = first
    return ones, others, edges


def _compare(sent, threshold: float):
    schema = pa.schema([("cls", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def rows(cls, n) -> pa.RecordBatch:
        some = n > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(cls[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(n[some].astype(np.int64))],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = sums = None
        key, parts = None, []

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal one, sums
            cls, n, x = (np.concatenate(p) for p in zip(*parts))
            now = Tile(cls, n.astype(float), x, sent.value.get(x.shape[1]))
            if key[2] < 0:
                if one is not None:
                    yield rows(one.cls, sums)
                one, sums = now, np.zeros(len(cls))
                return
            same = key[2] == key[0]
            ones, others, edges = compare(one, now, same, threshold)
            sums += ones + others if same else ones
            if not same:
                yield rows(now.cls, others)
            if edges:
                a, b = zip(*edges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())], schema=schema)

        for batch in batches:
            a, g, b, cls, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            values, ends = vectors_of(batch.column(5))
            for s, e in runs(a, g, b):
                at = int(a[s]), int(g[s]), int(b[s])
                if at != key and parts:
                    yield from done()
                    parts = []
                key = at
                parts.append((cls[s:e], n[s:e], values[ends[s]:ends[e]].reshape(e - s, -1)))
        if parts:
            yield from done()
        if one is not None:
            yield rows(one.cls, sums)
    return run


def links(classes: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Stored (cls, other, n): edges of spanning forests, and where ``other`` is null, numbers of linked rows.

    ``classes`` has (cls, h1, h2, lab, n, vec), one row per distinct vector and label.
    """
    spark = classes.sparkSession
    sent = spark.sparkContext.broadcast(bases(classes))
    led = classes.select(F.col("cls").alias("h1"), "h2", "lab", "n", "vec").mapInArrow(
        _lead(sent), "h1 long, h2 long, lab long, n long, vec array<double>, dims int, lead double")
    order = ["lab", "dims", "lead", "h1"]
    tiled = stored(led.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _tile(sent, tile_rows),
        "tile long, h1 long, h2 long, lab long, dims int, n long, vec array<double>, low array<double>, high array<double>"),
        "tiles")
    members = tiled.filter("h1 IS NOT NULL").select("tile", F.col("h1").alias("cls"), "n", "vec")
    boxes = tiled.filter("h1 IS NULL").select("tile", "lab", "dims", "low", "high")
    a, b = boxes.alias("a"), boxes.alias("b")
    gaps = F.zip_with(
        F.zip_with("a.low", "b.high", lambda x, y: x - y), F.zip_with("b.low", "a.high", lambda x, y: x - y),
        lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), 2))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)
    pairs = a.join(b, (F.col("a.lab") == F.col("b.lab")) & (F.col("a.dims") == F.col("b.dims"))
                   & (F.col("a.tile") <= F.col("b.tile")) & (apart <= 2 - 2 * threshold + NEAR))
    fan = max(1, -(-boxes.count() // AT_ONCE))
    pairs = stored(pairs.select(
        F.col("a.tile").alias("a"), F.pmod(F.xxhash64("b.tile"), F.lit(fan)).alias("g"),
        F.col("b.tile").alias("b")), "tile-pairs")
    # the tile itself comes first, then those that it is compared with
    first = pairs.select("a", "g").distinct().select("a", "g", F.lit(-1).cast("long").alias("b"), F.col("a").alias("tile"))
    sides = first.unionByName(pairs.withColumn("tile", F.col("b")))
    work = sides.join(members, "tile").select("a", "g", "b", "cls", "n", "vec")
    return stored(work.repartition("a", "g").sortWithinPartitions("a", "g", "b", "cls").mapInArrow(
        _compare(sent, threshold), "cls long, other long, n long"), "links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    label = column(vectors, label_col)
    c = column(vectors, vec_col).cast("array<double>")
    usable = label.isNotNull() & finite(c) & F.coalesce(F.exists(c, lambda x: x != 0), F.lit(False))
    rows = vectors.select(column(vectors, id_col).cast("long").alias("vec_id"), usable.alias("usable"),
                          F.xxhash64(label).alias("lab"), c.alias("vec"), *keys(label, c))
    classes = rows.filter("usable").groupBy(*KEYS).agg(
        F.first("lab").alias("lab"), F.count("*").alias("n"), F.min("vec_id").alias("first_id"),
        F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    found = links(classes, threshold, tile_rows)
    roots = components(found.filter("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    counts = found.filter("other IS NULL").groupBy("cls").agg(F.sum("n").alias("n_linked"))
    told = classes.select("cls", *KEYS, "n", "first_id").join(counts, "cls", "left").join(
        roots.withColumnRenamed("node", "cls"), "cls", "left")
    told = stored(told.select(
        *KEYS, "first_id", F.coalesce("root", "cls").alias("root"),
        (F.col("n") - 1 + F.coalesce("n_linked", F.lit(0))).alias("n_links")), "told")
    least = told.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = told.join(least, "root").select(*KEYS, "n_links", "component_id")
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    inside = rows.filter("usable").select("vec_id", *KEYS).join(told, list(KEYS)).select(
        "vec_id", "n_links", "component_id", kept)
    alone = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return inside.unionByName(alone)
