"""Collocations by SON partitioning: frequent phrases, scored by their weakest cut.

Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words at spaces and
tabs, A-Z lower-cased; all counts are per language (null: ``und``). Tasks store the
words of their texts as blocks of numbers; the blocks of a task belong to one of
``SHARDS`` shards, which is a fixed number, so a shard's share of the support stays
well above one however large the corpus is.

1. Words are counted exactly; a phrase can only be frequent if its words are.
2. Each shard is mined completely. Its support is the overall one in proportion to
   its share of the language's words (rounded up), so a phrase that is frequent
   overall reaches it in one shard at least. A shard is as large as it must be: its
   blocks count their own phrases, and one grouping per level adds them up, pairs
   first, then phrases of three words and more whose pairs are all frequent there.
3. The union of the shards' phrases is counted in all blocks, exactly, by text. Left
   out are phrases that cannot reach the support: by their counts where they are
   frequent, and by the most that shards in which they are not can add.

Between the passes go bit maps of at most ``MAP_BITS`` bits, over hashes: a bit too
many lets a phrase be counted that is dropped afterwards, and none is ever missing.
Inside a block phrases are told apart by 64-bit hashes, across blocks by their text.

A phrase's score is ``floor(1000 * a * n / (l * r))`` in exact decimals. Phrases that
stand only inside one longer frequent phrase are dropped.

Null and empty texts have no words. Repeated rows count as often as they come, and
so do ties, which go by text. No rows give none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import column, stored

SUPPORT = 100
LONGEST = 5
TOP = 2000
SHARDS = 4
#: Bytes of text in a block, as far as texts are shorter.
BLOCK_BYTES = 3_000_000
#: Bit maps have at most so many bits (16 MB), and 16 for each entry up to there.
MAP_BITS = 1 << 27
SLICE_BITS = 1 << 20
NO_LANG = "und"
SEED = 42
#: Rows that the last ranking of a language gets from each part.
RANK_ROWS = 200_000

_BLOCKS = "shard int, lang string, n_words long, vocab binary, ids binary"
#: A-Z in lower case, tabs as spaces, and what ends a piece as a line feed.
_BYTES = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def numbers(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a text, and the text as their numbers from 1; 0 ends a piece."""
    text = text.translate(_BYTES)
    words = text.split()
    vocab = list(set(words))
    of = dict(zip(vocab, range(1, len(vocab) + 1)))
    ids = np.fromiter(map(of.__getitem__, words), np.uint32, len(words))
    raw = np.frombuffer(text, np.uint8)
    ends = raw == 10
    apart = ends | (raw == 32)
    starts = ~apart
    starts[1:] &= apart[:-1]
    piece = np.cumsum(ends, dtype=np.int64)[starts]
    return vocab, np.insert(ids, np.flatnonzero(np.diff(piece)) + 1, 0)


def _tokenize(shards: int, block_bytes: int):
    schema = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("n_words", pa.int64()),
                        ("vocab", pa.binary()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, pack = TaskContext.get().partitionId() % shards, zstandard.ZstdCompressor(level=1)
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def block(lang: str) -> pa.RecordBatch:
            vocab, ids = numbers(b"\n".join(held.pop(lang)))
            del size[lang]
            packed = [pack.compress(x) for x in (b" ".join(vocab), ids.astype("<u4").tobytes())]
            row = (shard, lang, int(np.count_nonzero(ids)), *packed)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                data = memoryview(text.as_buffer()).tobytes()
                held.setdefault(lang, []).append(data)
                size[lang] = size.get(lang, 0) + len(data) + 1
                if size[lang] >= block_bytes:
                    yield block(lang)
                elif sum(size.values()) >= 4 * block_bytes:
                    yield block(max(size, key=size.get))
        for lang in list(held):
            yield block(lang)
    return run


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hashes with their bits spread anew; a wrap-around is meant."""
    h = (h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def longer(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return mixed(h * np.uint64(0x2545F4914F6CDD1D) + words)


def bit_map(hashes: DataFrame) -> np.ndarray:
    """The bits (packed) of the column ``h``, salted by ``salt``, at most ``MAP_BITS`` of them.

    Tasks build slices of it, and only these reach the driver.
    """
    bits = min(MAP_BITS, max(1 << 16, 1 << (16 * max(1, hashes.count()) - 1).bit_length()))
    each = min(bits, SLICE_BITS)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            salt = batch.column(1).to_numpy(zero_copy_only=False)
            at = np.empty(len(h), np.int64)
            for s in np.unique(salt).tolist():
                some = salt == s
                at[some] = (mixed(h[some], s) & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // each), pa.array(at % each)], names=["slice", "at"])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, marks = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())],
                names=["slice", "bits"])
        for batch in batches:
            part, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if part[a] != now:
                    if now is not None:
                        yield done()
                    now, marks = int(part[a]), np.zeros(each, np.uint8)
                marks[at[a:b]] = 1
        if now is not None:
            yield done()

    found = hashes.select("h", "salt").mapInArrow(places, "slice long, at long").repartition("slice")
    out = np.zeros(bits // 8, np.uint8)
    for r in found.sortWithinPartitions("slice").mapInArrow(slices, "slice long, bits binary").collect():
        out[r.slice * each // 8:(r.slice + 1) * each // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def has(bits: np.ndarray, h: np.ndarray, salt: int = 0) -> np.ndarray:
    at = mixed(h, salt) & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Block:
    """A stored block: words, numbers, and per place the word's hash."""

    def __init__(self, lang: str, vocab: bytes, ids: bytes, frequent: np.ndarray | None = None):
        unpack = zstandard.ZstdDecompressor().decompress
        self.vocab = unpack(vocab).split(b" ")
        self.ids = np.frombuffer(unpack(ids), "<u4")
        if frequent is None:
            return
        # the same number as Spark's xxhash64(lang, word)
        seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
        known = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.vocab), np.uint64, len(self.vocab))
        good = np.concatenate([[False], has(frequent, known)])
        self.words = np.concatenate([np.zeros(1, np.uint64), known])[self.ids]
        self.good = good[self.ids]

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids, minlength=len(self.vocab) + 1)[1:]

    def phrases(self, longest: int, pairs: np.ndarray | None = None, salt: int = 0):
        """(length, places, hashes) of all phrases of frequent words, from two words on.

        With ``pairs``, longer ones are given only if the map has all their pairs.
        """
        at = np.flatnonzero(self.good[:-1] & self.good[1:]).astype(np.int32)
        h = longer(self.words[at], self.words[at + 1])
        yield 2, at, h
        two = np.zeros(len(self.ids) + 1, bool)
        two[at if pairs is None else at[has(pairs, h, salt)]] = True
        some = two[at]
        at, h = at[some], h[some]
        for k in range(3, longest + 1):
            some = two[np.minimum(at + k - 2, len(self.ids))]
            at, h = at[some], h[some]
            h = longer(h, self.words[at + k - 1])
            yield k, at, h

    def text(self, at: int, k: int) -> bytes:
        return b" ".join([self.vocab[i - 1] for i in self.ids[at:at + k].tolist()])


def _blocks(batches: Iterator[pa.RecordBatch], frequent=None):
    """(row, block) of each block that has words."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
            if row["n_words"]:
                yield row, Block(row["lang"], row.pop("vocab"), row.pop("ids"), frequent)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, block in _blocks(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["lang"]] * len(block.vocab), pa.string()), pa.array(block.vocab, pa.binary()),
             pa.array(block.counts())], names=["lang", "word", "n"])


def _mine(frequent, pairs, longest: int):
    """Counts of a block's pairs, or with ``pairs`` of its longer phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if pairs is None else pairs.value
        for row, block in _blocks(batches, frequent.value):
            for k, _, h in block.phrases(2 if pairs is None else longest, bits, row["shard"]):
                if (k == 2) == (pairs is None) and len(h):
                    found, n = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), row["shard"], np.int32)), pa.array(found.view(np.int64)), pa.array(n),
                         pa.array(np.full(len(n), row["least"])), pa.array(np.full(len(n), row["short"]))],
                        names=["shard", "h", "n", "least", "short"])
    return run


def _count(frequent, wanted, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _blocks(batches, frequent.value):
            for k, at, h in block.phrases(longest, wanted.value):
                some = has(wanted.value, h)
                at, h = at[some], h[some]
                if not len(h):
                    continue
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(n), pa.string()),
                     pa.array([block.text(i, k) for i in at[first].tolist()], pa.binary()), pa.array(n)],
                    names=["lang", "phrase", "n"])
    return run


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                     longest: int = LONGEST, shards: int = SHARDS,
                     block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: (lang, n) of all words, (lang, phrase, a) of frequent words, and of phrases."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(column(docs, lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       column(docs, text_col).cast("string").cast("binary").alias("text"))
    blocks = stored(rows.mapInArrow(_tokenize(shards, block_bytes), _BLOCKS), "blocks")
    totals = stored(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")).filter("n > 0"), "totals")

    def known(counts: DataFrame, name: str) -> DataFrame:
        return stored(counts.groupBy("lang", F.col(name).cast("string").alias("phrase")).agg(
            F.sum("n").alias("a")).filter(F.col("a") >= support), f"frequent-{name}")

    words = known(blocks.mapInArrow(_count_words, "lang string, word binary, n long"), "word")
    frequent = spark.sparkContext.broadcast(
        bit_map(words.select(F.xxhash64("lang", "phrase").alias("h"), F.lit(0).alias("salt"))))
    # a shard's share of the support, rounded up; ``short`` is what is missing to the
    # support if a phrase comes just below it everywhere
    shares = blocks.groupBy("shard", "lang").agg(F.sum("n_words").alias("w")).join(totals, "lang").select(
        "shard", "lang", F.greatest(
            F.lit(1).cast("long"), F.ceil(support * F.col("w").cast("decimal(38,0)") / F.col("n")).cast("long")).alias("least"))
    short = shares.groupBy("lang").agg((support - F.sum(F.col("least") - 1)).alias("short"))
    shares = stored(shares.join(short, "lang"), "shares")
    in_shards = blocks.join(shares, ["shard", "lang"]).select(*blocks.columns, "least", "short")

    def mined(pairs, name: str) -> DataFrame:
        counts = in_shards.mapInArrow(_mine(frequent, pairs, longest), "shard int, h long, n long, least long, short long")
        sums = counts.groupBy("shard", "h").agg(*[f(c).alias(c) for f, c in (
            (F.sum, "n"), (F.first, "least"), (F.first, "short"))])
        return stored(sums.filter("n >= least"), name)

    pairs = mined(None, "pairs")
    in_shard = spark.sparkContext.broadcast(bit_map(pairs.select("h", F.col("shard").alias("salt"))))
    candidates = pairs.unionByName(mined(in_shard, "longer")).groupBy("h").agg(
        F.sum(F.col("n") - F.col("least") + 1).alias("over"), F.first("short").alias("short"))
    candidates = stored(candidates.filter("over >= short").select("h", F.lit(0).alias("salt")), "candidates")
    wanted = spark.sparkContext.broadcast(bit_map(candidates))
    return totals, words, known(
        blocks.mapInArrow(_count(frequent, wanted, longest), "lang string, phrase binary, n long"), "phrase")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 longest: int = LONGEST, top: int = TOP, shards: int = SHARDS,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    totals, words, phrases = frequent_phrases(docs, text_col, lang_col, support, longest, shards, block_bytes)
    parts = words.unionByName(phrases)
    split = phrases.select("lang", "phrase", "a", F.split("phrase", " ").alias("w"))
    size = F.size("w")

    # phrases that stand nowhere but inside one longer phrase
    inside = split.filter(size > 2).select(
        "lang", "a", "w", F.explode(F.sequence(F.lit(2), size - 1)).alias("k")).select(
        "lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1)).alias("i")).select(
        "lang", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    stay = split.join(inside, ["lang", "phrase"], "left").filter("most IS NULL OR most < a").drop("most")

    cuts = stay.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, size), " ").alias("right"))
    # a part of a frequent phrase is frequent, so its count is there
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"]).join(totals, "lang")

    def wide(name: str):
        return F.col(name).cast("decimal(19,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * wide("n"),
                            wide("l") * wide("r"))
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = stored(weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "scored")

    # first in parts of a language, so that no task ranks all of one
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    n_parts = max(1, -(-scored.count() // RANK_ROWS))
    part = F.pmod(F.xxhash64("phrase"), F.lit(n_parts))
    near = scored.withColumn("part", part).withColumn(
        "at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("at") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
