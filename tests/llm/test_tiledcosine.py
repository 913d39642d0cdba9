import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm import tiledcosine as T

SCHEMA = "vec_id long, embedding array<double>, label int"


def slow(rows, threshold=T.THRESHOLD):
    """Every pair in plain floats."""
    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    def near(a, b):
        a, b = np.array(a, float), np.array(b, float)
        a, b = a / 2 ** math.floor(math.log2(abs(a).max())), b / 2 ** math.floor(math.log2(abs(b).max()))
        return float((a * b).sum() / math.sqrt((a * a).sum() * (b * b).sum())) >= threshold
    n, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and near(a[1], b[1]):
                n[i] += 1
                n[j] += 1
                root[top(i)] = top(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(top(i), []).append(r[0])
    out = []
    for i, r in enumerate(rows):
        least = min((x for x in ids[top(i)] if x is not None), default=None)
        out.append((r[0], n[i], least, r[0] == least))
    return sorted(out, key=repr)


def check(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = T.near_duplicates(df, **more)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == slow(rows)


def clustered(rng, n, dims, spread):
    centres = rng.normal(size=(6, dims))
    return centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dims)) * spread


@pytest.mark.parametrize("dims, spread, tile_rows", [(12, 0.1, 16), (40, 0.22, 50), (3, 0.3, 7), (1, 1.0, 8)])
def test_as_all_pairs(spark, dims, spread, tile_rows):
    rng = np.random.default_rng(dims)
    x = clustered(rng, 300, dims, spread)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, rng.integers(0, 2, 300)))]
    check(spark, rows, tile_rows=tile_rows)


def test_copies_chains_and_the_threshold_itself(spark):
    angle = 0.3  # neighbours are linked, those after them not
    chain = [(100 + i, [math.cos(angle * i), math.sin(angle * i)], 1) for i in range(9)]
    exact = [(1, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 2), (2, [93.0, 36.0, 7.0, 2.0, 1.0, 1.0], 2), (3, [92.9, 36.0, 7.0, 2.0, 1.0, 1.0], 2)]
    copies = [(50 - i, [0.5, 0.25, 0.125], 3) for i in range(40)] + [(60, [-0.0, 1.0, 0.0], 3), (61, [0.0, 1.0, 0.0], 3)]
    check(spark, chain + exact + copies, tile_rows=3)


def test_odd_vectors(spark):
    x = [0.1, 0.2, 0.3]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [0.1, None, 0.3], 1), (5, [0.1, float("nan"), 0.3], 1),
            (6, [0.1, float("inf"), 0.3], 1), (7, x, None), (8, x, 1), (9, x, 1), (9, x, 1), (None, x, 1), (10, x, 2),
            (None, [1.0, -1.0], 7), (11, [0.1, 0.2], 1), (12, [1e300, 2e300, 3e300], 1), (13, [1e-310, 2e-310, 3e-310], 1),
            (-4, [-0.1, -0.2, -0.3], 1)]
    want = slow(rows)
    got = T.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    # a vector without an id stays by itself where its component has none
    assert sorted(map(tuple, got), key=repr) == [
        (i, n, c, True if i is None and c is None else kept) for i, n, c, kept in want]


def test_nothing_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert T.near_duplicates(none).collect() == []
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("h1", "cls", "n", "vec", "a.b", "tile")})
    assert sorted(map(tuple, T.near_duplicates(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_only_pairs_that_may_reach_it_are_summed_up(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(64, 32))
    tile = T.Tile(np.arange(64), np.ones(64), x, None)
    found = T.linked(tile, tile, 0, 64, True, 0.3)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (found == np.triu(u @ u.T >= 0.3, 1)).all()
