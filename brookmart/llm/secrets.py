"""Secrets in texts: fixed patterns, and strings that a primed compressor finds new.

Assignments, access keys and long hexadecimal runs are found by pattern. Beside
them, any long string after a sensitive word is a candidate: it is compressed
together with the text around it by zstandard, primed with a dictionary of what is
frequent in all texts, whatever could be a secret taken out. Its marginal bytes, what it
adds to the compressed surroundings, tell how new it is; prose and identifiers add
little, keys add nearly all of their bytes. Those above ``NOVEL`` are reported.

Null and empty texts have no spans. Each row is judged by itself, so copies and
ties get equal results; no rows give none. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brookmart.llm.common import column, numbered

# The patterns of the base kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "novel")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

# Words that make a string after them worth a look.
SENSITIVE = ("key", "secret", "token", "passw", "passphrase", "pwd", "auth", "credential", "bearer", "private")
#: A candidate begins so many characters after a sensitive word at most.
REACH = 40
LEAST_NOVEL = 16
#: Text on either side that a candidate is compressed with.
AROUND = 400
#: Marginal bytes for each character: identifiers add up to 0.8, random strings 1 and more.
NOVEL = 0.9
#: Longer candidates are measured in pieces of so many characters.
PIECE = 64
DICTIONARY_BYTES = 16_384
#: Strings of so many bytes are counted in all texts, by hashes of so many bits.
GRAM, GRAM_BITS = 8, 18
#: Texts are cut into segments of so many bytes, and these dealt by content into groups of
#: which the best one is learned from.
SEGMENT, GROUPS = 64, 4096
#: Longer texts are counted in blocks of so many bytes.
BLOCK = 1 << 20

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_LONG_HEX = re.compile(b"[0-9a-f]{%d}" % LEAST_HEX)
_HEX = re.compile(HEX)
_SENSITIVE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_STRING = re.compile(r"[A-Za-z0-9+/_=-]+")
_LONG_STRING = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_NOVEL)


def base_spans(text: str, data: bytes, low: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns; ``low`` is ``data`` in lower case."""
    out = []
    if b"passw" in low or b"secret" in low or b"token" in low or b"key" in low:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if b"AKIA" in data:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if _LONG_HEX.search(data):
        out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def marginal_bytes(compressor, text: str, start: int, end: int) -> int:
    """What text[start:end] adds to the compressed size of the text around it.

    Repetitions of it there do not count: a secret that stands twice is new both times.
    Of a long one each piece is added to the surroundings by itself, so that what
    random characters cost at least counts as it does for a short one.
    """
    def size(s: str) -> int:
        return len(compressor.compress(s.encode("utf-8", "surrogatepass")))

    total, more = 0, LEAST_NOVEL - 1
    first = max(0, start - AROUND)
    left, right = text[max(0, first - more):start], text[end:end + AROUND + more]
    for at in range(start, end, PIECE):
        piece = text[at:min(at + PIECE, end)]
        parts = parts_of(piece)
        # what of the piece stands there again, even cut at the edge, is no surroundings
        before = blanked(left, parts)[min(first, more):].replace("\0", "")
        after = blanked(right, parts)[:AROUND].replace("\0", "")
        total += size(before + piece + after) - size(before + after)
    return total


def candidates(text: str, low: bytes) -> list[tuple[int, int]]:
    """Long mixed strings after sensitive words."""
    if not any(w.encode() in low for w in SENSITIVE):
        return []
    out, done = {}, 0
    for word in _SENSITIVE.finditer(text):
        if word.end() < done:  # inside a candidate
            continue
        for m in _STRING.finditer(text, word.end()):
            if m.start() - word.end() > REACH or "\n" in text[word.end():m.start()]:
                break
            s, e = m.span()
            if s not in out and e - s >= LEAST_NOVEL and not m[0].isalpha() and not m[0].isdigit():
                out[s] = done = e
    return list(out.items())


def novel_spans(compressor, text: str, low: bytes, base: list[tuple[int, int, str]],
                novel: float = NOVEL) -> list[tuple[int, int, str]]:
    return [(s, e, "novel") for s, e in candidates(text, low)
            if not any(a < e and s < b for a, b, _ in base)
            and marginal_bytes(compressor, text, s, e) >= novel * (e - s)]


def parts_of(string: str) -> set[str]:
    """All parts of ``LEAST_NOVEL`` characters."""
    return {string[i:i + LEAST_NOVEL] for i in range(len(string) - LEAST_NOVEL + 1)}


def blanked(text: str, parts: set[str]) -> str:
    """The text with these parts of its strings overwritten by zero characters."""
    out, at = [], 0
    for m in _LONG_STRING.finditer(text):
        for i in range(m.start(), m.end() - LEAST_NOVEL + 1):
            if text[i:i + LEAST_NOVEL] in parts:
                out += [text[at:i], "\0" * (i + LEAST_NOVEL - max(at, i))]
                at = i + LEAST_NOVEL
    return "".join([*out, text[at:]])


def learnable(text: str) -> bytes:
    """The text without assigned values and without any string long enough for a candidate.

    Such strings go wherever they stand; else a secret that several texts share, some without
    a sensitive word before it, would be learned and no longer be new.
    """
    data = text.encode("utf-8", "surrogatepass")
    given = [s for s in base_spans(text, data, data.lower()) if s[2] == "assign"]
    return _LONG_STRING.sub(" ", hidden(text, given, " ")).encode("utf-8", "surrogatepass")


def slots(data: bytes) -> np.ndarray:
    """The counter of each string of ``GRAM`` bytes, by its place."""
    grams = np.frombuffer(data, np.uint8).astype(np.uint64)
    for step in (1, 2, 4):
        grams = grams[:-step] | grams[step:] << np.uint64(8 * step)
    return (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for text in batch.column(0):
            data = learnable(text.as_py())
            yield from (data[i:i + BLOCK] for i in range(0, len(data), BLOCK))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, last = np.zeros(1 << GRAM_BITS, np.int64), np.zeros(1 << GRAM_BITS, np.int64)
    for data in _blocks(batches):
        if len(data) >= GRAM:
            at = slots(data)
            places = np.arange(len(at))
            last[at] = places
            # each counter once, by the last place it has in the text
            counts[at[last[at] == places]] += 1
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["slot", "n"])


def _best(counts: np.ndarray):
    """The segment of each group whose strings are the most frequent, and their sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, bytes]] = {}
        for data in _blocks(batches):
            if len(data) < SEGMENT:
                continue
            sums = np.concatenate([[0], np.cumsum(counts[slots(data)])])
            starts = np.arange(0, len(data) - SEGMENT + 1, SEGMENT)
            scores = (sums[starts + SEGMENT - GRAM + 1] - sums[starts]).tolist()
            for at, score in zip(starts.tolist(), scores):
                segment = data[at:at + SEGMENT]
                group = zlib.crc32(segment) % GROUPS
                if group not in best or (score, segment) > best[group]:
                    best[group] = score, segment
        yield pa.RecordBatch.from_arrays([
            pa.array(list(best), pa.int64()), pa.array([x for x, _ in best.values()], pa.int64()),
            pa.array([x for _, x in best.values()], pa.binary())], names=["part", "score", "segment"])
    return run


def chosen(segments: list[bytes], counts: np.ndarray, n: int) -> list[bytes]:
    """At most ``n`` segments by what each adds to those before it, the greatest first; a
    string that is there already adds nothing."""
    left = counts.copy()
    queue = [(-int(left[slots(x)].sum()), x) for x in segments]
    heapq.heapify(queue)
    out = []
    while queue and len(out) < n:
        _, segment = heapq.heappop(queue)
        places = np.unique(slots(segment))
        adds = int(left[places].sum())
        if queue and -adds > queue[0][0]:
            if adds:
                heapq.heappush(queue, (-adds, segment))
            continue
        left[places] = 0
        out.append(segment)
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def train_dictionary(docs: DataFrame, text_col: str = "text") -> bytes:
    """A dictionary of what is frequent in all texts, without what could be a secret.

    In how many texts each short string stands is counted over all of them, by hashes. By
    these counts all segments of all texts compete, those of equal content as one, and the
    best of each group is learned from. The choice depends on no order or partitioning;
    tasks and the driver hold the counters and a segment for each group, however many
    texts there are.
    """
    import zstandard
    texts = docs.select(column(docs, text_col).cast("string").alias("text")).where("text IS NOT NULL")
    found = texts.mapInArrow(_count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << GRAM_BITS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    best = texts.mapInArrow(_best(counts), "part long, score long, segment binary").groupBy("part").agg(
        F.max(F.struct("score", "segment")).alias("best")).collect()
    pieces = sorted((bytes(r.best.segment) for r in best), key=lambda x: (zlib.crc32(x), x))
    half = DICTIONARY_BYTES // 2
    # the most useful last, where a dictionary is cheapest to refer to
    frequent = b"".join(chosen(pieces, counts, half // SEGMENT)[::-1])
    samples = [b"".join(pieces[i:i + 16]) for i in range(0, len(pieces), 16)]
    try:
        # what follows a trained dictionary is more content of it
        return zstandard.train_dictionary(half, samples).as_bytes() + frequent
    except zstandard.ZstdError:
        # too few texts to train on: their bytes themselves
        return frequent


_compressors: dict[bytes, object] = {}


def compressor(dictionary: bytes):
    key = hashlib.sha256(dictionary).digest()
    if key not in _compressors:
        import zstandard
        primed = zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None
        _compressors[key] = zstandard.ZstdCompressor(
            level=3, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
    return _compressors[key]


def spans_of(text: str, primed, novel: float = NOVEL):
    """Base spans and all spans of one text."""
    data = text.encode("utf-8", "surrogatepass")
    low = data.lower()
    base = base_spans(text, data, low)
    added = novel_spans(primed, text, low, base, novel)
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2]))) if added else base


def _scan(dictionary: bytes, novel: float):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_novel", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        primed = compressor(dictionary)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                base, every = spans_of(text.as_py() or "", primed, novel)
                n = Counter(kind for _, _, kind in every)
                rows.append((key, n["assign"], n["access"], n["hex"],
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), n["novel"]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", novel: float = NOVEL) -> DataFrame:
    """One row per row of ``docs``: counts of each kind and all spans."""
    dictionary = train_dictionary(docs, text_col)
    rows = docs.select(column(docs, id_col).cast("long").alias("doc_id"),
                       column(docs, text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan(dictionary, novel), (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"))


def hidden(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with each span, or run of overlapping spans, replaced by a mark."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
           novel: float = NOVEL) -> DataFrame:
    """All rows of ``docs`` with their secrets replaced; the length column follows."""
    dictionary = train_dictionary(docs, text_col)
    names = docs.columns
    at = names.index(text_col)
    chars_at = names.index(chars_col) if chars_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        primed = compressor(dictionary)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = [t and hidden(t, spans_of(t, primed, novel)[1]) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, batch.schema.field(at).type)
            if chars_at is not None:
                n = [old if a == b else len(b) for a, b, old in zip(
                    texts, clean, batch.column(chars_at).to_pylist())]
                columns[chars_at] = pa.array(n, batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    plain = numbered(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*names)
