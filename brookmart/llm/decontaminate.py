"""Benchmark passages in documents, by a positional inverted index kept in segments.

``build_index`` stores the postings of all documents' words: a segment holds whole
documents of about ``SEGMENT_WORDS`` words, its sorted term hashes, and for each
term the sorted list of places. ``search`` cuts the test items into windows,
counts the windows' terms over the whole index, and in each segment takes the
postings of a window's rarest term, shifts them by the term's offset and keeps
those found in the shifted lists of the next rarest terms, until all have agreed:
the exact phrase occurs there. Proximity asks that all terms lie near the rarest.

Windows are searched in blocks of a fixed number, which bounds what a task holds
of the test set; each block is one pass over the index. Terms are 64-bit hashes.

Null and empty texts have no words and give a row without hits. Repeated rows and
ties give a row each. An item without words has no window, items of one id count
as one, and a null id is written as an empty string. Without items, or without
documents, nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import ALNUM_BYTES, column, folder

WINDOW = 10
#: Words of a proximity match lie so near to the rarest one.
SLOP = 15
SEGMENT_WORDS = 1_000_000
BLOCK_WINDOWS = 200_000

_INDEX = ("segment long, doc_ids array<long>, doc_ends array<int>, "
          "terms binary, term_ends binary, places binary")
_FOUND = ("segment long, at int, doc_id long, n_words long, n_hit long, starts array<int>, "
          "ends array<int>, items array<string>, near array<string>")


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of bytes above ASCII, A-Z lower-cased."""
    return text.translate(ALNUM_BYTES).split()


def term(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _segment(number: int, ids: list, ends: list[int], found: list[bytes]) -> dict:
    coded = pa.array(found, pa.binary()).dictionary_encode()
    hashes = np.fromiter(map(term, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    codes = rank[coded.indices.to_numpy(zero_copy_only=False)] if found else np.empty(0, np.int32)
    places = np.argsort(codes, kind="stable").astype("<i4")
    term_ends = np.cumsum(np.bincount(codes, minlength=len(order))).astype("<i4")
    return {
        "segment": number, "doc_ids": ids, "doc_ends": ends,
        "terms": hashes[order].astype("<u8").tobytes(), "term_ends": term_ends.tobytes(),
        "places": places.tobytes(),
    }


def _index(segment_words: int):
    schema = pa.schema([
        ("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32())),
        ("terms", pa.binary()), ("term_ends", pa.binary()), ("places", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        ends: list[int] = []
        found: list[bytes] = []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found += words(memoryview(text.as_buffer()).tobytes()) if text.is_valid else []
                ids.append(key)
                ends.append(len(found))
                if len(found) >= segment_words:
                    yield pa.RecordBatch.from_pylist([_segment(number, ids, ends, found)], schema)
                    number, ids, ends, found = number + 1, [], [], []
        if ids:
            yield pa.RecordBatch.from_pylist([_segment(number, ids, ends, found)], schema)
    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index of all rows of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        column(docs, text_col).cast("string").cast("binary").alias("text"))
    path = folder(spark, "postings")
    rows.mapInArrow(_index(segment_words), _INDEX).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_INDEX).parquet(path)


def windows_of(items: Iterator, size: int) -> Iterator[tuple[str, list[int]]]:
    """(item, terms) of each window of the items' (id, text) rows."""
    for key, text in items:
        terms = [term(w) for w in words(text.encode("utf-8", "surrogatepass"))] if text else []
        for i in range(max(1, len(terms) - size + 1) if terms else 0):
            yield "" if key is None else str(key), terms[i:i + size]


def _blocks(items: DataFrame, size: int, most: int) -> Iterator[dict[tuple, set[str]]]:
    block: dict[tuple, set[str]] = {}
    for key, terms in windows_of(items.toLocalIterator(), size):
        block.setdefault(tuple(terms), set()).add(key)
        if len(block) >= most:
            yield block
            block = {}
    if block:
        yield block


def _counts(wanted):
    """Occurrences per segment of the wanted terms (a sorted array, broadcast)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch.column(0), batch.column(1)):
                terms = np.frombuffer(terms.as_buffer(), "<u8")
                n = np.diff(np.frombuffer(ends.as_buffer(), "<i4"), prepend=0)
                here = np.isin(terms, wanted.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms[here].view(np.int64)), pa.array(n[here].astype(np.int64))],
                    names=["term", "n"])
    return run


def _range_of(ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.where(which > 0, ends[which - 1], 0), ends[which]


def _occurrences(terms: np.ndarray, ends: np.ndarray, places: np.ndarray,
                 need: np.ndarray, offset: np.ndarray, slop: int, doc_starts: np.ndarray, doc_ends: np.ndarray):
    """Exact and near matches of windows in one segment.

    Near are places within ``slop`` of the rarest term, in its document. ``need`` has a row of terms per window, rarest first, and ``offset`` each
    term's place in the window (-1: no term). Returns (window, start) arrays, and
    the (window, place) of the rarest term for near matches.
    """
    nothing = np.empty(0, np.int64)
    if not len(terms) or not len(need):
        return (nothing, nothing), (nothing, nothing)
    at = np.searchsorted(terms, need)
    at[at == len(terms)] = 0
    alive = np.flatnonzero(((terms[at] == need) | (offset < 0)).all(axis=1))
    first, last = _range_of(ends, at[alive, 0])
    count = (last - first).astype(np.int64)
    window = np.repeat(alive, count)
    row = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    place = places[row].astype(np.int64)
    # all postings as one sorted list of (term, place)
    postings = (np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(ends, prepend=0)) << 32) | places
    width = need.shape[1]

    exact_w, start = window, place - offset[window, 0]
    exact_w, start = exact_w[start >= 0], start[start >= 0]
    near_w, near_p = window, place
    doc = np.searchsorted(doc_ends, place, "right")
    near_a = np.maximum(place - slop, doc_starts[doc])
    near_b = np.minimum(place + slop, doc_ends[doc] - 1)
    for k in range(1, width):
        sure = offset[exact_w, k] < 0
        want = (at[exact_w, k].astype(np.int64) << 32) | (start + offset[exact_w, k])
        i = np.minimum(np.searchsorted(postings, want), len(postings) - 1)
        ok = sure | (postings[i] == want)
        exact_w, start = exact_w[ok], start[ok]
        sure = offset[near_w, k] < 0
        low = (at[near_w, k].astype(np.int64) << 32) | near_a
        high = (at[near_w, k].astype(np.int64) << 32) | near_b
        i = np.minimum(np.searchsorted(postings, low), len(postings) - 1)
        ok = sure | ((postings[i] >= low) & (postings[i] <= high))
        near_w, near_p, near_a, near_b = near_w[ok], near_p[ok], near_a[ok], near_b[ok]
    return (exact_w, start), (near_w, near_p)


def _search(sent, slop: int, all_rows: bool):
    schema = pa.schema([
        ("segment", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("n_hit", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
        ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string())),
    ])

    def of_segment(row: dict) -> list[dict]:
        need, offset, items = sent.value
        doc_ends = np.asarray(row["doc_ends"], np.int64)
        doc_starts = np.concatenate([[0], doc_ends[:-1]])
        (win, start), (near_w, near_p) = _occurrences(
            np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["term_ends"], "<i4"),
            np.frombuffer(row["places"], "<i4"), need, offset, slop, doc_starts, doc_ends)
        end = start + (offset[win] >= 0).sum(axis=1)
        doc = np.searchsorted(doc_ends, start, "right")
        inside = end <= doc_ends[np.minimum(doc, len(doc_ends) - 1)]
        win, start, end, doc = win[inside], start[inside], end[inside], doc[inside]
        total = int(doc_ends[-1]) if len(doc_ends) else 0
        change = np.bincount(start, minlength=total + 1) - np.bincount(end, minlength=total + 1)
        hit = np.cumsum(change)[:total] > 0
        before = np.concatenate([[0], np.cumsum(hit)])
        n_hit = before[doc_ends] - before[doc_starts]
        found: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for d, w in set(zip(doc.tolist(), win.tolist())):
            found.setdefault(d, set()).update(items[w])
        near_d = np.searchsorted(doc_ends, near_p, "right")
        for d, w in set(zip(near_d.tolist(), near_w.tolist())):
            near.setdefault(d, set()).update(items[w])
        for d, names in found.items():
            near.setdefault(d, set()).update(names)
        out = []
        for d in range(len(doc_ends)) if all_rows else sorted(set(found) | set(near)):
            s, e = int(doc_starts[d]), int(doc_ends[d])
            starts = ends = []
            if n_hit[d]:
                edge = np.diff(np.concatenate([[0], hit[s:e].astype(np.int8), [0]]))
                starts, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
            out.append({
                "segment": row["segment"], "at": d, "doc_id": row["doc_ids"][d], "n_words": e - s,
                "n_hit": int(n_hit[d]), "starts": starts, "ends": ends,
                "items": sorted(found.get(d, ())), "near": sorted(near.get(d, ())),
            })
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist(of_segment(row), schema)
    return run


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           window: int = WINDOW, slop: int = SLOP, block: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per indexed document: its words hit, where, and by which items."""
    spark = index.sparkSession
    tests = items.select(column(items, id_col), column(items, text_col).cast("string"))
    parts = []
    for found in _blocks(tests, window, block):
        wins, names = list(found), list(found.values())
        wanted = spark.sparkContext.broadcast(np.unique(np.fromiter(
            (t for w in wins for t in w), np.uint64)))
        counts = (
            index.select("terms", "term_ends").mapInArrow(_counts(wanted), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n"))
        )
        # no more rows than the block has terms
        count = {r.term & 0xFFFFFFFFFFFFFFFF: r.n for r in counts.toLocalIterator()}
        need = np.zeros((len(wins), window), np.uint64)
        offset = np.full((len(wins), window), -1, np.int64)
        for i, w in enumerate(wins):
            order = sorted(range(len(w)), key=lambda k: (count.get(w[k], 0), k))
            need[i, :len(w)] = [w[k] for k in order]
            offset[i, :len(w)] = order
        occurs = np.array([all(t in count for t in w) for w in wins], bool)
        names = [sorted(n) for n, ok in zip(names, occurs) if ok]
        sent = spark.sparkContext.broadcast((need[occurs], offset[occurs], names))
        parts.append(index.mapInArrow(_search(sent, slop, not parts), _FOUND))
    if not parts:
        sent = spark.sparkContext.broadcast(
            (np.zeros((0, window), np.uint64), np.zeros((0, window), np.int64), []))
        parts = [index.mapInArrow(_search(sent, slop, True), _FOUND)]
    if len(parts) == 1:
        return _finish(parts[0])
    # documents hit by several blocks: ranges united, items put together
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    ranges = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    merged = every.groupBy("segment", "at").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.aggregate(
            ranges, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda a, r: F.struct(
                (a["n"] + F.greatest(r["ends"] - F.greatest(r["starts"], a["end"]), F.lit(0))).alias("n"),
                F.greatest(a["end"], r["ends"]).alias("end")),
            lambda a: a["n"]).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    return _finish(merged)


def _finish(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near_items"), "items",
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a word inside a test window, all columns kept.

    Whether a row goes depends on its text only; rows are told apart by a 64-bit
    hash of id and text.
    """
    key = F.xxhash64(column(docs, id_col), column(docs, text_col))
    keyed = docs.select(key.alias("doc_id"), column(docs, text_col).alias("text"))
    bad = search(build_index(keyed), items).filter("contaminated").select(
        F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, key == F.col("__bad"), "left_anti")
