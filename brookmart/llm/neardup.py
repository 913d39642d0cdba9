"""Near copies by SimHash, with candidates found by pigeonring chains of segments.

A fingerprint is cut into five segments on a ring. If two fingerprints differ in at
most four bits, the ring has a place from which the differences of the first 1, 2,
..., 5 segments are at most 0, 1, 2, 3 and 4 (their proportional shares of the
budget). So the pair shares a whole segment and all but one bit of the next: each
distinct fingerprint is listed once for each first segment and each masked bit of
the segment after it, and only fingerprints under one such key are compared, chain
by chain, before all bits are counted.

A group under a key gives a spanning forest of its links, never all its pairs. A
group with more than ``GROUP`` members is not held in memory: its members meet in
points at most two bits away from each. Two members share a point just if they
differ in at most four bits, and a point has a bounded number of members.

Exact copies are one fingerprint. Null and empty texts have fingerprint zero and
are linked like any other; ties and repeated rows are copies. No rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brookmart.llm.common import numbered, stored
from brookmart.llm.components import components
from brookmart.llm.fingerprints import SHINGLE, fingerprint, fingerprints

MOST = 4
GROUP = 2048
#: Bits of the segments, from the lowest; together 64.
WIDTHS = (13, 13, 13, 13, 12)


def _layout() -> tuple[list[int], list[int]]:
    """First bit and mask of each segment."""
    firsts = [sum(WIDTHS[:i]) for i in range(len(WIDTHS))]
    return firsts, [((1 << w) - 1) << f for w, f in zip(WIDTHS, firsts)]


def chain_masks() -> list[list[int]]:
    """For each first segment the bits of the chains of 1, 2, ... segments."""
    _, masks = _layout()
    m = len(masks)
    out = []
    for i in range(m):
        chain, bits = [], 0
        for k in range(m):
            bits |= masks[(i + k) % m]
            chain.append(bits)
        out.append(chain)
    return out


def keys_of(prints: np.ndarray) -> np.ndarray:
    """The keys of each fingerprint (rows), one per first segment and masked bit."""
    firsts, masks = _layout()
    m = len(masks)
    out = []
    for i in range(m):
        j = (i + 1) % m
        head = (prints & np.uint64(masks[i])) >> np.uint64(firsts[i])
        tail = (prints & np.uint64(masks[j])) >> np.uint64(firsts[j])
        for bit in range(WIDTHS[j]):
            cleared = tail & ~np.uint64(1 << bit)
            tag = np.uint64(i << 4 | bit)
            out.append(tag << np.uint64(26) | head << np.uint64(13) | cleared)
    return np.stack(out, axis=1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 10_000):
            prints = batch.slice(i, 10_000).column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = keys_of(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)),
                 pa.array(np.repeat(prints, keys.shape[1]).view(np.int64))], names=["key", "a"])


def _near(one, others: np.ndarray, chain: list[int], most: int) -> np.ndarray:
    """Which others are linked to one by the chain from its first segment."""
    at = np.arange(len(others))
    for k, bits in enumerate(chain, 1):
        differ = np.bitwise_count((others[at] ^ one) & np.uint64(bits))
        at = at[differ <= k * most // len(chain)]
    return at


def forest(prints: np.ndarray, chain: list[int], most: int = MOST) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of a group."""
    out, waiting = [], prints
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            one = reached.pop()
            at = _near(one, waiting, chain, most)
            out += [(int(one), int(x)) for x in waiting[at]]
            reached += list(waiting[at])
            waiting = np.delete(waiting, at)
    return out


def _linked(most: int, group: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hot", pa.int64())])

    def batch_of(a, b, hot) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                           pa.array(hot, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains = chain_masks()
        keys, prints, hot = np.empty(0, np.int64), np.empty(0, np.int64), None

        def groups(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal hot
            if hot is not None and len(keys):
                end = int(np.searchsorted(keys, hot, "right"))
                if end:
                    yield batch_of(prints[:end], [None] * end, keys[:end])
                    keys, prints = keys[end:], prints[end:]
                hot = None if len(keys) else hot
            edge = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
            a, b = [], []
            for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
                if e - s > group:
                    yield batch_of(prints[s:e], [None] * (e - s), keys[s:e])
                    continue
                pairs = forest(np.unique(prints[s:e]).view(np.uint64), chains[int(keys[s]) >> 30], most)
                a += [x for x, _ in pairs]
                b += [x for _, x in pairs]
            if a:
                yield batch_of(np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64),
                               [None] * len(a))

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False)])
            # the last group may go on in the next batch
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield from groups(keys[:cut], prints[:cut])
            keys, prints = keys[cut:], prints[cut:]
            if len(keys) > group:
                yield batch_of(prints, [None] * len(prints), keys)
                hot, keys, prints = int(keys[0]), keys[:0], prints[:0]
        yield from groups(keys, prints)
    return run


def points_of(key: int, one: int, most: int = MOST) -> list[int]:
    """All values at most ``most // 2`` of the bits away that a key leaves open."""
    _, masks = _layout()
    i, bit = key >> 30, key >> 26 & 15
    j = (i + 1) % len(masks)
    fixed = masks[i] | masks[j] & ~(1 << (_layout()[0][j] + bit))
    free = [1 << k for k in range(64) if not fixed >> k & 1]
    out = [one]
    for n in range(1, most // 2 + 1):
        for some in combinations(free, n):
            flip = 0
            for f in some:
                flip |= f
            out.append(one ^ flip)
    return out


def _points(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.array(points_of(key, one & 0xFFFFFFFFFFFFFFFF, most), np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), key)), pa.array(found), pa.array(np.full(len(found), one))],
                    names=["key", "point", "a"])
    return run


def links(prints: DataFrame, most: int = MOST, group: int = GROUP) -> DataFrame:
    """Edges (a, b) whose components are those of all links of distinct fingerprints.

    ``prints`` has one column, ``fingerprint``, without repeats.
    """
    keyed = prints.select("fingerprint").mapInArrow(_keys, "key long, a long")
    found = stored(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(
            _linked(most, group), "a long, b long, hot long"), "links")
    edges = found.filter("hot IS NULL").select("a", "b")
    hot = found.filter("hot IS NOT NULL").select(F.col("hot").alias("key"), "a").distinct()
    if hot.isEmpty():
        return edges
    met = hot.repartition("key", "a").mapInArrow(_points(most), "key long, point long, a long")
    # members of a point are told apart by its few open bits, so there are not many
    over = Window.partitionBy("key", "point").orderBy("a")
    chained = met.select("a", F.lag("a").over(over).alias("b")).filter("b IS NOT NULL")
    return edges.unionByName(chained.distinct())


def groups(tagged: DataFrame, most: int = MOST, group: int = GROUP) -> DataFrame:
    """(fingerprint, root, component_id) of each distinct fingerprint of (doc_id, fingerprint).

    ``component_id`` is the least doc_id whose fingerprint can be reached by links.
    """
    classes = stored(tagged.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes, most, group))
    rooted = stored(classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"),
        F.col("root").isNotNull().alias("linked")), "rooted")
    least = rooted.filter("linked").groupBy("root").agg(F.min("first_id").alias("component_id"))
    columns = ["fingerprint", "root", "component_id"]
    return rooted.filter("linked").join(least, "root").select(*columns).unionByName(
        rooted.filter("NOT linked").withColumnRenamed("first_id", "component_id").select(*columns))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    most: int = MOST, shingle: int = SHINGLE, group: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: its fingerprint in hex and its component."""
    tagged = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    found = groups(tagged, most, group)
    return tagged.join(found, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                most: int = MOST, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near copies: the one of the least id, all columns kept.

    Null ids come after all others; of rows that repeat an id, one stays.
    """
    names = docs.columns
    at, id_at = names.index(text_col), names.index(id_col)
    plain = numbered(docs)
    schema = StructType([*plain.schema.fields, StructField("mark", LongType())])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py().encode("utf-8", "surrogatepass"), shingle) if t.is_valid else 0
                     for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(found, np.uint64).view(np.int64))],
                names=[*batch.schema.names, "mark"])
    tagged = stored(plain.mapInArrow(tag, schema).withColumn("row", F.monotonically_increasing_id()), "tagged")
    rows = tagged.select(
        "row", F.col(f"c{id_at}").cast("long").alias("doc_id"), F.col("mark").alias("fingerprint"))
    found = groups(rows, most)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    best = rows.groupBy("fingerprint").agg(first.alias("best")).join(found, "fingerprint")
    stays = best.groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.row").alias("__stays"))
    kept = tagged.join(stays, F.col("row") == F.col("__stays"), "left_semi")
    return kept.drop("mark", "row").toDF(*names)
