"""Bulk-synchronous best-fit packing of token sequences.

Documents are cut into pieces of at most ``capacity`` tokens. Full pieces are
sequences of their own. The others are packed in supersteps:

1. Pieces and the gaps of open sequences are range-sorted by size, largest first.
2. Each range is swept once: a piece takes the smallest gap at hand that holds it
   (its successor); the gap, now smaller, stays at hand for the pieces after it.
3. Pieces a range could not place go to gaps other ranges have left over, nearest
   range first. Only counts per range are needed to say who gets which: conflicts
   are resolved by rank, and a much larger gap takes several pieces at once.
4. Gaps are updated, and the next superstep begins. When nothing fits any more, the
   largest pieces left open as many new sequences as the others' tokens need.

Pieces of more than half the capacity never share a sequence, so they open theirs
at the start. Each superstep writes its outcome to the shared folder. What fits no
gap and is few enough for one range is packed by one last sweep.

Null and empty texts are a sequence part of the end id alone; rows that repeat are
packed one by one. No rows give no sequences.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import column, crc32_ids, partitions_for, stored
from brookmart.llm.tokens import TEXTS, encoder

CAPACITY = 1024
END_ID = 2
#: Rows that one range of a superstep holds.
RANGE_ROWS = 50_000
#: New sequences are opened once a superstep places less than this share.
SLOW = 0.1

_PIECES = ("uid long, doc_id long, piece int, start long, length long, ids binary, ids_crc32 long")
#: Outcomes of a sweep: placed piece, piece left, gap at hand, gap to be sorted anew.
PLACED, LEFT, GAP, LATER = range(4)
_SWEPT = "kind int, id long, size long, bin long, offset long, part int, rank long"


def _cut(vocabulary: str, capacity: int, end_id: int):
    schema = pa.schema([
        ("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        tokens = encoder(vocabulary, spaces=True)
        end = tokens.dtype.type(end_id)
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                some, rows = batch.slice(i, TEXTS), []
                for key, ids in zip(some.column(0).to_pylist(), tokens.encode(some.column(1))):
                    ids = np.append(ids, end)
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((uid, key, n, a, b - a, ids[a:b].tobytes(), crc32_ids(ids[a:b])))
                        uid += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The stored pieces of all documents, each with a number of its own."""
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        column(docs, text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(_cut(vocabulary, capacity, end_id), _PIECES), "pieces")


def sweep(rows: Iterator[tuple[int, bool, int]], capacity: int, opens: bool = False):
    """Best fit over (size, is a piece, id) in descending order of size, gaps first.

    Yields (kind, id, size, bin, offset). ``opens``: a piece that fits nowhere opens
    a sequence, else it is left.
    """
    at_hand: list[tuple[int, int]] = []  # (room, bin), the smallest last
    smaller: list[tuple[int, int]] = []  # gaps below the sizes reached so far
    for size, is_piece, key in rows:
        while smaller and -smaller[0][0] >= size:
            room, b = heapq.heappop(smaller)
            at_hand.append((-room, b))
        if not is_piece:
            at_hand.append((size, key))
            continue
        if at_hand:
            room, b = at_hand.pop()
        elif opens:
            room, b = capacity, key
        else:
            yield LEFT, key, size, None, None
            continue
        yield PLACED, key, size, b, capacity - room
        room -= size
        if room >= size:
            at_hand.append((room, b))
        elif room:
            heapq.heappush(smaller, (-room, b))
    for room, b in reversed(at_hand):
        yield GAP, b, room, None, None
    for room, b in smaller:
        yield LATER, b, -room, None, None


def flows(ranges: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which left pieces go to which left gaps, from counts per range.

    ``ranges`` has (range, pieces left, size of the largest, gaps left, room of the
    smallest) in descending order of sizes. Yields (range of pieces, first rank,
    last rank + 1, range of gaps, first rank, pieces per gap).
    """
    open_gaps: list[list[int]] = []
    out = []
    for part, n_left, largest, n_gaps, room in ranges:
        done = 0
        while done < n_left and open_gaps:
            gaps = open_gaps[-1]
            each = max(1, gaps[3] // largest)
            take = min(n_left - done, gaps[2] * each)
            used = -(-take // each)
            out.append((part, done, done + take, gaps[0], gaps[1], each))
            done, gaps[1], gaps[2] = done + take, gaps[1] + used, gaps[2] - used
            if not gaps[2]:
                open_gaps.pop()
        if n_gaps:
            open_gaps.append([part, 0, n_gaps, room])
    return out


def _swept(capacity: int, opens: bool):
    schema = pa.schema([
        ("kind", pa.int32()), ("id", pa.int64()), ("size", pa.int64()), ("bin", pa.int64()),
        ("offset", pa.int64()), ("part", pa.int32()), ("rank", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks, rows = TaskContext.get().partitionId(), [0] * 4, []
        given = (row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(3))))
        for kind, key, size, b, offset in sweep(given, capacity, opens):
            rows.append((kind, key, size, b, offset, part, ranks[kind]))
            ranks[kind] += 1
            if len(rows) >= 50_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def place(sizes: DataFrame, capacity: int = CAPACITY, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(id, bin, offset) for (id, size) rows with sizes from 1 to ``capacity``.

    A bin has the id of the piece that opened it.
    """
    spark = sizes.sparkSession
    columns = ["id", "bin", "offset"]
    first = F.col("size") > capacity // 2
    zero = F.lit(0).cast("long").alias("offset")
    done = [sizes.filter(first).select("id", F.col("id").alias("bin"), zero)]
    gaps = sizes.filter(first & (F.col("size") < capacity)).select(
        "id", (capacity - F.col("size")).alias("size"))
    left = sizes.filter(~first)
    n_left, n_gaps = left.count(), gaps.count()
    while n_left:
        n = partitions_for(spark, n_left + n_gaps, range_rows)
        order = [F.desc("size"), "is_piece", "id"]
        rows = (
            gaps.select("size", F.lit(False).alias("is_piece"), "id")
            .unionByName(left.select("size", F.lit(True).alias("is_piece"), "id"))
            .repartitionByRange(n, *order).sortWithinPartitions(*order)
        )
        swept = stored(rows.mapInArrow(_swept(capacity, False), _SWEPT), "sweep")
        stats = {}
        # a row for each range and kind
        for r in swept.groupBy("part", "kind").agg(
                F.count("*").alias("n"), F.max("size").alias("most"), F.min("size").alias("least"),
                F.sum("size").alias("total")).collect():
            stats[r.part, r.kind] = r
        def of(part, kind, what):
            return stats[part, kind][what] if (part, kind) in stats else 0
        parts = sorted({p for p, _ in stats})
        # the partition numbers of a range-sort ascend with the order
        sent = flows([
            (p, of(p, LEFT, "n"), of(p, LEFT, "most"), of(p, GAP, "n"), of(p, GAP, "least")) for p in parts])
        placed = sum(of(p, PLACED, "n") for p in parts)
        done.append(swept.filter(F.col("kind") == PLACED).select(*columns))
        unplaced = swept.filter(F.col("kind") == LEFT).select("id", "size", "part", "rank")
        rooms = swept.filter(F.col("kind") == GAP).select(
            F.col("id").alias("gap"), F.col("size").alias("room"), "part", "rank")
        later = swept.filter(F.col("kind") == LATER).select("id", "size")
        if sent:
            table = spark.createDataFrame(sent, "p int, lo long, hi long, gap_part int, gap_rank long, each long")
            moved = unplaced.join(table, (F.col("part") == F.col("p")) & (F.col("rank") >= F.col("lo"))
                                  & (F.col("rank") < F.col("hi")), "left")
            k = F.floor((F.col("rank") - F.col("lo")) / F.col("each"))
            moved = stored(moved.select(
                "id", "size", "gap_part", (F.col("gap_rank") + k).alias("gap_at"),
                "part", "rank"), "moved")
            at = ["gap_part", "gap_at"]
            into = moved.filter("gap_part IS NOT NULL").join(
                rooms.withColumnsRenamed({"part": "gap_part", "rank": "gap_at"}), at, "right")
            # a gap takes no more pieces than fit, so its group is small
            over = Window.partitionBy("gap").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
            fill = stored(into.select(
                "id", "size", "gap", "room",
                (capacity - F.col("room") + F.coalesce(F.sum("size").over(over), F.lit(0))).alias("offset"),
            ), "fill")
            done.append(fill.filter("id IS NOT NULL").select("id", F.col("gap").alias("bin"), "offset"))
            gaps = fill.groupBy("gap").agg(
                (F.first("room") - F.coalesce(F.sum("size"), F.lit(0))).alias("size")
            ).filter("size > 0").select(F.col("gap").alias("id"), "size").unionByName(later)
            left = moved.filter("gap_part IS NULL").select("id", "size", "part", "rank")
            placed += sum(f[2] - f[1] for f in sent)
        else:
            gaps = rooms.select(F.col("gap").alias("id"), F.col("room").alias("size")).unionByName(later)
            left = unplaced
        before, n_left = n_left, n_left - placed
        if n_left and placed <= SLOW * before:
            if not placed and n_left <= range_rows:
                # nothing fits a gap, and one range holds all that is left
                last = left.select("size", F.lit(True).alias("is_piece"), "id").coalesce(1)
                swept = last.sortWithinPartitions(*order).mapInArrow(_swept(capacity, True), _SWEPT)
                done.append(stored(swept, "sweep").filter(F.col("kind") == PLACED).select(*columns))
                n_left = 0
            else:
                left, gaps, n_left, opened = _open(left, gaps, capacity)
                done.append(opened)
        n_gaps = n_gaps if not n_left else gaps.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _open(left: DataFrame, gaps: DataFrame, capacity: int):
    """Opens sequences for the largest pieces left, as many as all tokens left need."""
    stats = left.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("total"),
                                     F.max("rank").alias("last")).orderBy("part").collect()
    need = -(-sum(r.total for r in stats) // capacity)
    # ranges descend in size, and so do the ranks in them; ranges before this one open all
    part, seen = None, 0
    for r in stats:
        if seen + r.n >= need:
            part = r.part
            break
        seen += r.n
    inside = Window.partitionBy("part").orderBy("rank")
    cut = left.filter(F.col("part") == part).select(
        "id", "size", "part", F.row_number().over(inside).alias("k"))
    opened = stored(
        left.filter(F.col("part") < part).select("id", "size")
        .unionByName(cut.filter(F.col("k") <= need - seen).select("id", "size")), "opened")
    rest = left.filter(F.col("part") > part).select("id", "size").unionByName(
        cut.filter(F.col("k") > need - seen).select("id", "size"))
    gaps = gaps.unionByName(opened.select("id", (capacity - F.col("size")).alias("size")).filter("size > 0"))
    zero = F.lit(0).cast("long").alias("offset")
    return rest, gaps, sum(r.n for r in stats) - need, opened.select("id", F.col("id").alias("bin"), zero)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: its ids (packed little-endian integers) and its place."""
    cut = pieces(docs, vocabulary, id_col, text_col, capacity, end_id)
    where = place(cut.select(F.col("uid").alias("id"), F.col("length").alias("size")), capacity)
    return cut.join(where, cut["uid"] == where["id"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset", "ids")
