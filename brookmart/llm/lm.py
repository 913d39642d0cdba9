"""A bigram language model by deleted interpolation.

The probability of a word is a mixture of its share after the word before it, its
share of all words, and an equal share of all words, by training counts. The
weights belong to classes of the context's frequency (powers of two) and are
learned by expectation-maximisation on a part of the training documents, the
deleted part, whose own counts are taken off the estimates meanwhile.

Documents are gathered in blocks of about ``BLOCK_WORDS`` words. A block asks for
the counts of its distinct n-grams, sorted by hash: one message for each range of
hashes, to the task that adds up that range over all blocks and answers in the same
order. So a frequent n-gram is one entry per block, no vocabulary is held whole
anywhere, and what is sent grows with the corpus. N-grams are told apart by 64-bit
hashes. Only totals and a table of bounded size, of how often which pair of
estimates comes up in each class, reach the driver.

Null and empty texts are the end token alone. Repeated rows count as often as they
come. A null id belongs to the training documents. No rows give none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import column, stored

BLOCK_WORDS = 1_000_000
#: Hash ranges: one for so many words, and no fewer than LEAST_RANGES.
RANGE_WORDS, LEAST_RANGES = 1_000_000, 64
#: Remainders of crc32 modulo 10: held out from learning, and the deleted part.
HELD_OUT, DELETED = 0, 1
CLASSES = 48
ROUNDS = 60
#: Estimates are binned in half powers of two, from 2**-LOW on.
LOW, BINS = 48, 192
ADDED = 0.1

_BLOCK = ("block long, part int, n_words long, doc_ids array<long>, doc_ends binary, codes binary, hashes binary")
_SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed bytes: all low bytes first, then the next ones."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(raw.T.tobytes())


def expand(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()


def remainder(doc_id: int | None) -> int:
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10


def part_of(doc_id: int | None) -> int:
    """0: held out; 1: the deleted part of the training documents; 2: the rest of them."""
    r = remainder(doc_id)
    return 0 if r == HELD_OUT else 1 if r == DELETED else 2


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _block(number: int, part: int, ids: list, ends: list[int], found: list[bytes]) -> dict:
    # the end token is an empty word, which no text has
    coded = pa.array(found, pa.binary()).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64)
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return {
        "block": number, "part": part, "n_words": len(found), "doc_ids": ids,
        "doc_ends": squeeze(np.asarray(ends)), "codes": squeeze(rank[coded.indices.to_numpy()]),
        "hashes": squeeze(np.diff(hashes[order], prepend=np.uint64(0))),
    }


def _blocks(block_words: int):
    schema = pa.schema([
        ("block", pa.int64()), ("part", pa.int32()), ("n_words", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("doc_ends", pa.binary()), ("codes", pa.binary()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_blocks: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = part_of(key)
                ids, ends, found = open_blocks.setdefault(part, ([], [], []))
                if text.is_valid:
                    found += words(memoryview(text.as_buffer()).tobytes())
                found.append(b"")
                ids.append(key)
                ends.append(len(found))
                if len(found) >= block_words:
                    yield pa.RecordBatch.from_pylist([_block(number, part, *open_blocks.pop(part))], schema)
                    number += 1
        for part, held in sorted(open_blocks.items()):
            yield pa.RecordBatch.from_pylist([_block(number, part, *held)], schema)
            number += 1
    return run


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Ngrams:
    """The distinct n-grams of a block in order of their hashes, and where they are."""

    def __init__(self, row: dict):
        self.codes = expand(row["codes"]).astype(np.int64)
        self.ends = expand(row["doc_ends"]).astype(np.int64)
        self.words = np.cumsum(expand(row["hashes"]), dtype=np.uint64)
        end = int(self.codes[-1])
        self.before = np.concatenate([[end], self.codes[:-1]])
        pairs, self.pair_of = np.unique(self.before * len(self.words) + self.codes, return_inverse=True)
        hashes = mixed(self.words[pairs // len(self.words)], self.words[pairs % len(self.words)])
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.pairs, self.pair_of = hashes[order], rank[self.pair_of]


def range_ends(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of n equal ranges of hash values ends among sorted hashes."""
    tops = [((k + 1) << 64) // n - 1 for k in range(n)]
    return np.searchsorted(hashes, np.array(tops, np.uint64), "right")


def _requests(n_ranges: int):
    schema = pa.schema([("range", pa.int32()), ("size", pa.int32()), ("block", pa.int64()), ("part", pa.int32()),
                        ("hashes", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams, out = Ngrams(row), []
                for size, hashes, of in ((1, grams.words, grams.codes), (2, grams.pairs, grams.pair_of)):
                    counts = np.bincount(of, minlength=len(hashes))
                    start = 0
                    for k, end in enumerate(range_ends(hashes, n_ranges).tolist()):
                        if end > start:
                            some = hashes[start:end]
                            out.append({
                                "range": k, "size": size, "block": row["block"], "part": row["part"],
                                "hashes": squeeze(np.diff(some, prepend=np.uint64(0))),
                                "counts": squeeze(counts[start:end]) if row["part"] else b""})
                        start = end
                yield pa.RecordBatch.from_pylist(out, schema)
    return run


_REQUEST = "range int, size int, block long, part int, hashes binary, counts binary"
_ANSWER = "range int, size int, block long, counts binary, deleted binary, total long, kinds long, total_deleted long"


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over all blocks, for requests sorted by range and n-gram size."""
    schema = pa.schema([
        ("range", pa.int32()), ("size", pa.int32()), ("block", pa.int64()), ("counts", pa.binary()),
        ("deleted", pa.binary()), ("total", pa.int64()), ("kinds", pa.int64()), ("total_deleted", pa.int64())])

    def answered(key: tuple[int, int], asked: list[tuple]) -> Iterator[pa.RecordBatch]:
        hashes = [np.cumsum(expand(h), dtype=np.uint64) for _, _, h, _ in asked]
        every, at = np.unique(np.concatenate(hashes), return_inverse=True)
        given = np.concatenate([
            expand(c).astype(np.int64) if part else np.zeros(len(h), np.int64)
            for h, (_, part, _, c) in zip(hashes, asked)])
        is_deleted = np.repeat([part == 1 for _, part, _, _ in asked], [len(h) for h in hashes])
        counts = np.bincount(at, given, len(every)).astype(np.int64)
        deleted = np.bincount(at, given * is_deleted, len(every)).astype(np.int64)
        yield pa.RecordBatch.from_pylist([{
            "range": key[0], "size": key[1], "block": None, "total": int(counts.sum()),
            "kinds": int((counts > 0).sum()), "total_deleted": int(deleted.sum())}], schema)
        start = 0
        for h, (block, part, _, _) in zip(hashes, asked):
            mine = at[start:start + len(h)]
            start += len(h)
            yield pa.RecordBatch.from_pylist([{
                "range": key[0], "size": key[1], "block": block, "counts": squeeze(counts[mine]),
                "deleted": squeeze(deleted[mine]) if part == 1 else None}], schema)

    key, asked = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != key:
                if asked:
                    yield from answered(key, asked)
                key, asked = row[:2], []
            asked.append(row[2:])
    if asked:
        yield from answered(key, asked)


def _counts_of(rows: list[dict], size: int, what: str) -> np.ndarray:
    some = sorted((r for r in rows if r["size"] == size), key=lambda r: r["range"])
    return np.concatenate([expand(r[what]).astype(np.int64) for r in some])


def context_class(counts: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else one more than the power of two reached."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], CLASSES - 1)


def bin_of(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        at = np.floor(2 * np.log2(ratio)) + LOW
    return np.where(ratio > 0, np.clip(at, 0, BINS - 2) + 1, 0).astype(np.int64)


def bin_value(at: np.ndarray) -> np.ndarray:
    return np.where(at > 0, 2.0 ** ((at - 1 - LOW + 0.5) / 2), 0.0)


def _pairs_seen(total: int, kinds: int):
    """How often the deleted part has which class and estimates, per block."""
    def run(_key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = answers.to_pylist()
        cells, n = np.empty(0, np.int64), np.empty(0, np.int64)
        if blocks.num_rows and rows:
            grams = Ngrams(blocks.to_pylist()[0])
            one = _counts_of(rows, 1, "counts") - _counts_of(rows, 1, "deleted")
            two = _counts_of(rows, 2, "counts") - _counts_of(rows, 2, "deleted")
            context = one[grams.before]
            share2 = two[grams.pair_of] / np.maximum(context, 1) * (kinds + 1)
            share1 = one[grams.codes] / max(total, 1) * (kinds + 1)
            cells, n = np.unique(
                (context_class(context) * BINS + bin_of(share2)) * BINS + bin_of(share1), return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})
    return run


def learn_weights(cells: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights (pair, word, equal share) of each class, by EM."""
    cls, at2, at1 = cells // (BINS * BINS), cells // BINS % BINS, cells % BINS
    parts = np.stack([bin_value(at2), bin_value(at1), np.ones(len(cells))], axis=1)
    weights = np.full((CLASSES, 3), 1 / 3)
    for _ in range(rounds):
        shares = parts * weights[cls]
        shares *= (n / np.maximum(shares.sum(axis=1), 1e-300))[:, None]
        # a little of each estimate everywhere keeps all weights above zero
        sums = np.stack([np.bincount(cls, shares[:, k], CLASSES) for k in range(3)], axis=1) + 0.01
        weights = sums / sums.sum(axis=1, keepdims=True)
    # a context never seen has no pairs
    weights[0, 1:] /= weights[0, 1:].sum()
    weights[0, 0] = 0
    return weights


def _scores(total: int, kinds: int, weights: np.ndarray):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(_key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return schema.empty_table()
        row, rows = blocks.to_pylist()[0], answers.to_pylist()
        grams = Ngrams(row)
        one, two = _counts_of(rows, 1, "counts"), _counts_of(rows, 2, "counts")
        context = one[grams.before]
        w = weights[context_class(context)]
        chance = (w[:, 0] * two[grams.pair_of] / np.maximum(context, 1)
                  + w[:, 1] * (one / max(total, 1))[grams.codes] + w[:, 2] / (kinds + 1))
        base = np.log10((one + ADDED) / (total + ADDED * (kinds + 1)))[grams.codes]
        starts = np.concatenate([[0], grams.ends[:-1]])
        return pa.table([
            pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"] == 0] * len(starts)),
            pa.array(grams.ends - starts), pa.array(np.add.reduceat((one > 0)[grams.codes].astype(np.int64), starts)),
            pa.array(np.full(len(starts), total)), pa.array(np.add.reduceat(base, starts)),
            pa.array(np.add.reduceat(np.log10(chance), starts))], schema=schema)
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``; ``score`` is the log10 probability of its text."""
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        column(docs, text_col).cast("string").cast("binary").alias("text"))
    blocks = stored(rows.mapInArrow(_blocks(block_words), _BLOCK), "blocks")
    n_words = blocks.agg(F.sum("n_words")).first()[0] or 0
    n_ranges = max(LEAST_RANGES, -(-n_words // RANGE_WORDS))
    asked = blocks.mapInArrow(_requests(n_ranges), _REQUEST)
    answers = stored(
        asked.repartition("range").sortWithinPartitions("range", "size", "block")
        .mapInArrow(_answers, _ANSWER), "answers")
    totals = answers.filter("block IS NULL AND size = 1").agg(
        F.sum("total"), F.sum("kinds"), F.sum("total_deleted")).first()
    total, kinds, deleted = (int(x or 0) for x in totals)
    told = answers.filter("block IS NOT NULL").select("range", "size", "block", "counts", "deleted")

    seen = blocks.filter("part = 1").groupBy("block").cogroup(
        told.filter("deleted IS NOT NULL").groupBy("block")).applyInArrow(
            _pairs_seen(total - deleted, kinds), "cell long, n long")
    # at most CLASSES * BINS * BINS rows
    cells = seen.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = learn_weights(np.array([r.cell for r in cells], np.int64), np.array([r.n for r in cells], np.int64))
    return blocks.groupBy("block").cogroup(told.drop("deleted").groupBy("block")).applyInArrow(
        _scores(total, kinds, weights), _SCORED)
