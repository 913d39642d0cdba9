"""Personal data: fixed patterns, and a character tagger that adds to them.

The tagger (``tagger.py``) is trained on windows around labelled spans of a bounded
sample of the documents. The labels are what the patterns find there; each labelled
span is also put in with other digits, letters and separators, so that the tagger
learns forms the patterns do not have. All kinds hold a digit or an ``@``, so every
such character of every text is covered by windows, which overlap by half. Each
window is decoded by itself, and parts of a span that windows cut off are put
together; of the spans of all windows of a text, which may
contradict each other, those with the greatest sum of scores that do not overlap
are taken. Spans of the patterns always stay; the tagger's are added where they
overlap none and have the shape of their kind.

Null and empty texts have no spans. Rows are judged one by one: copies and ties get
equal results, and no rows give none. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm import tagger
from brookmart.llm.common import column, some_texts

KINDS = ("email", "ip", "card", "phone")
#: Documents sampled for training, their longest length, and the windows taken.
SAMPLE, SAMPLE_CHARS, SAMPLE_WINDOWS = 600, 20_000, 1500
#: Rows these are picked from.
POOL = 24_000
#: Batches the tagger learns from; fewer windows come more often.
STEPS, BATCH = 320, 64
WINDOW, STRIDE = 64, 32
#: Mean probability of the tags of a span that is added.
SURE = 0.9

# The patterns of the base kinds. A run of digits is entered at its
# first digit only, which finds the same and keeps long runs cheap.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile("[0-9@]")
_DIGITS = re.compile("[^0-9]")

#: Characters told apart by the tagger; letters and all others are four classes.
_MARKS = "0@.+-_() ,:/=\n\"'"
_SYMBOLS = {c: i + 5 for i, c in enumerate(_MARKS)}
N_SYMBOLS = len(_MARKS) + 5
N_TAGS = 1 + 2 * len(KINDS)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, by start and then kind."""
    if not _ANCHOR.search(text):
        return []
    out = [(s, e, "email") for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def symbols(text: str) -> np.ndarray:
    out = np.empty(len(text), np.int64)
    for i, c in enumerate(text):
        out[i] = (_SYMBOLS["0"] if "0" <= c <= "9" else _SYMBOLS[c] if c in _SYMBOLS
                  else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if c.isalpha() else 4)
    return out


def windows(text: str) -> list[int]:
    """Starts of windows that cover each anchor with at least half a stride around."""
    starts: list[int] = []
    for m in _ANCHOR.finditer(text):
        first = max(0, (m.start() - STRIDE // 2) // STRIDE - 1) * STRIDE
        for s in range(max(first, starts[-1] + STRIDE if starts else 0), m.start() + 1, STRIDE):
            starts.append(s)
    return starts


def _window(text: str, start: int) -> np.ndarray:
    some = symbols(text[start:start + WINDOW])
    return np.pad(some, (0, WINDOW - len(some)))


def tags_of(spans: list[tuple[int, int, str]], start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    for s, e, kind in spans:
        a, b = max(s - start, 0), min(e - start, WINDOW)
        if a < b:
            k = 1 + 2 * KINDS.index(kind)
            out[a:b] = k + 1
            if s >= start:
                out[a] = k
    return out


def varied(span: str, kind: str, rng: np.random.Generator) -> str:
    """The span with other letters and digits, and in a form of its kind."""
    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))
    if kind == "email":
        return "".join(chr(rng.integers(97, 123)) if c.isalpha() else digits(1) if c.isdigit() else c for c in span)
    if kind == "ip":
        return ".".join(str(n) for n in rng.integers(1, 256, 4))
    if kind == "card":
        gap = ("", " ", "-", ".")[rng.integers(4)]
        return gap.join(digits(4) for _ in range(4))
    form = ("+{} ({}) {}-{}", "({1}) {2}-{3}", "{1}-{2}-{3}", "+{} {} {} {}")[rng.integers(4)]
    return form.format(rng.integers(1, 99), digits(3), digits(3), digits(4))


def training_windows(texts: list[str], most: int = SAMPLE_WINDOWS, seed: int = 5):
    """(symbols, tags) of windows of labelled texts and of their varied copies."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []

    def add(text: str, spans: list[tuple[int, int, str]], start: int) -> None:
        xs.append(_window(text, start))
        ys.append(tags_of(spans, start))

    for text in texts:
        if len(xs) >= most:
            break
        spans, end = [], 0
        for s, e, kind in base_spans(text):
            if s >= end:  # one tag per character
                spans.append((s, e, kind))
                end = e
        if not spans:
            continue
        # numbers that are cards but for their check digit say neither yes nor no
        unclear = [m.span() for m in _CARD.finditer(text)
                   if 12 <= len(_DIGITS.sub("", m[0])) <= 19 and not any(s == m.start() for s, _, _ in spans)]
        for start in windows(text)[:20]:
            if not any(s < start + WINDOW and start < e for s, e in unclear):
                add(text, spans, start)
        for s, e, kind in spans[:20]:
            for _ in range(6):
                new = varied(text[s:e], kind, rng)
                left, right = text[max(0, s - 40):s], text[e:e + 40]
                if _ANCHOR.search(left + right):
                    continue
                whole = left + new + right
                add(whole, [(len(left), len(left) + len(new), kind)],
                    int(rng.integers(0, max(1, min(len(left), len(whole) - WINDOW) + 1))))
    return (np.stack(xs), np.stack(ys)) if xs else None


def learn(texts: list[str], steps: int = STEPS) -> tagger.Params | None:
    """The trained tagger; None if no text has a labelled span."""
    found = training_windows(texts)
    if found is None:
        return None
    epochs = -(-steps // -(-len(found[0]) // BATCH))
    return tagger.train(tagger.new_params(N_SYMBOLS, N_TAGS, 8, 16), *found, epochs, BATCH)


def sample_texts(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE,
                 longest: int = SAMPLE_CHARS) -> list[str]:
    """At most ``sample`` texts with a digit or an @ followed by more, of least hash."""
    texts = docs.select(column(docs, text_col).cast("string").alias("text"))
    return some_texts(texts, sample, POOL, longest, F.col("text").rlike("@[A-Za-z0-9]|[0-9][0-9. -]+[0-9]"))


def reconcile(spans: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """The spans that overlap nowhere and have the greatest sum of scores."""
    best: dict[tuple[int, int, str], float] = {}
    for s, e, kind, score in spans:
        best[s, e, kind] = max(score, best.get((s, e, kind), 0))
    order = sorted(best, key=lambda x: (x[1], x[0], x[2]))
    ends = [x[1] for x in order]
    sums, took = [0.0], []
    for i, x in enumerate(order):
        k = bisect.bisect_right(ends, x[0], 0, i)
        weight = sums[k] + best[x] * (x[1] - x[0])
        took.append((weight > sums[-1], k))
        sums.append(max(sums[-1], weight))
    out, i = [], len(order)
    while i:
        if took[i - 1][0]:
            out.append((*order[i - 1], best[order[i - 1]]))
            i = took[i - 1][1]
        else:
            i -= 1
    return out[::-1]


def has_shape(text: str, start: int, end: int, kind: str) -> bool:
    """Whether a tagged span is whole, and could be of its kind at all."""
    span = text[start:end]
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    n = len(_DIGITS.sub("", span))
    if kind == "email":
        return 0 < span.find("@") < len(span) - 1
    if any(c.isalpha() for c in span) or not span[-1].isdigit():
        return False
    if kind == "card":  # without its check digit a long number is just a number
        return 12 <= n <= 19 and luhn(_DIGITS.sub("", span))
    return span.count(".") == 3 and 4 <= n <= 12 if kind == "ip" else 7 <= n <= 15


class Piece(NamedTuple):
    """A span as far as windows show it: whether its beginning and end are cut off."""

    start: int
    end: int
    kind: str
    cut_left: bool
    cut_right: bool
    total: float
    #: Probabilities of its last characters.
    tail: np.ndarray


def pieces_of(path: np.ndarray, sure: np.ndarray, start: int, length: int) -> list[Piece]:
    """The spans of a decoded window of a text of this length."""
    if not path.any():
        return []
    out, begin, path = [], 0, path.tolist()
    while begin < WINDOW:
        tag = path[begin]
        # at a window's left edge a span may begin with any of its tags: it goes on from
        # the window before, or stands at the very start of the text
        if not tag or (tag % 2 == 0 and begin):
            begin += 1
            continue
        inner, end = tag + tag % 2, begin + 1
        while end < WINDOW and path[end] == inner:
            end += 1
        if start + end <= length:
            p = sure[begin:end].astype(float)
            out.append(Piece(start + begin, start + end, KINDS[(tag - 1) // 2], begin == 0 and start > 0,
                             end == WINDOW and start + WINDOW < length, float(p.sum()), p))
        begin = end
    return out


def _put_together(one: Piece, other: Piece) -> Piece | None:
    """A piece that is cut off on the right, and one of the next window that meets it."""
    tail = other.tail[max(0, one.start - other.start):]
    start = other.end - len(tail)
    if other.kind != one.kind or not len(tail) or start > one.end:
        return None
    shared = one.tail[len(one.tail) - (one.end - start):]
    n = min(len(shared), len(tail))
    tail = np.concatenate([(shared[:n] + tail[:n]) / 2, tail[n:]])
    total = one.total - float(shared.sum()) + float(tail.sum())
    return Piece(one.start, other.end, one.kind, one.cut_left, other.cut_right, total, tail)


def stitched(pieces: dict[int, list[Piece]]) -> list[Piece]:
    """Whole spans that several windows (by their start) show parts of."""
    out, opened, last = [], [], None
    for start in sorted(pieces):
        if last != start - STRIDE:
            opened = []
        now: dict[tuple[int, str], Piece] = {}
        for other in pieces[start]:
            found = [x for x in (_put_together(one, other) for one in opened) if x]
            out += [x for x in found if not x.cut_left and not x.cut_right]
            # what has lost its beginning becomes no whole span any more
            for x in [*found, other]:
                if x.cut_right and not x.cut_left:
                    now.setdefault((x.start, x.kind), x)
        opened, last = list(now.values()), start
    return out


def tagged_spans(params: tagger.Params, texts: list[str],
                 least: float = SURE) -> list[list[tuple[int, int, str, float]]]:
    """Reconciled spans of each text.

    Spans cut off by a window are put together with their parts in the windows next
    to it, which are decoded as well if they hold no anchor.
    """
    at = [(i, s) for i, t in enumerate(texts) for s in windows(t)]
    seen, pieces = set(at), [{} for _ in texts]
    while at:
        more = []
        for k in range(0, len(at), 2048):
            some = at[k:k + 2048]
            paths, sure = tagger.decode(params, np.stack([_window(texts[i], s) for i, s in some]))
            for (i, s), path, p in zip(some, paths, sure):
                pieces[i][s] = pieces_of(path, p, s, len(texts[i]))
                for x in pieces[i][s]:
                    more += [(i, s - STRIDE)] * x.cut_left + [(i, s + STRIDE)] * x.cut_right
        at = sorted(set(more) - seen)
        seen.update(at)
    out = []
    for text, parts in zip(texts, pieces):
        found = [x for some in parts.values() for x in some if not x.cut_left and not x.cut_right]
        found += [x for x in stitched(parts)
                  if x.total >= least * (x.end - x.start) and has_shape(text, x.start, x.end, x.kind)]
        out.append(reconcile([(x.start, x.end, x.kind, x.total / (x.end - x.start)) for x in found]))
    return out


def spans_of(params: tagger.Params | None, texts: list[str], least: float = SURE):
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    added = tagged_spans(params, texts, least) if params else [[] for _ in texts]
    out = []
    for text, own, more in zip(texts, base, added):
        new = [(s, e, k) for s, e, k, p in more if p >= least and has_shape(text, s, e, k)
               and not any(a < e and s < b for a, b, _ in own)]
        out.append((own, sorted([*own, *new], key=lambda x: (x[0], KINDS.index(x[2])))))
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(params: tagger.Params | None, least: float):
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS],
                        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some, rows = batch.slice(i, 1000), []
                texts = [t or "" for t in some.column(1).to_pylist()]
                for key, (base, every) in zip(some.column(0).to_pylist(), spans_of(params, texts, least)):
                    n = Counter(kind for _, _, kind in base)
                    rows.append((key, *[n[k] for k in KINDS], hashlib.sha256(_joined(base).encode()).hexdigest(),
                                 _joined(every), len(every) - len(base)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SURE) -> DataFrame:
    """One row per row of ``docs``: counts of the patterns' spans, and all spans."""
    params = learn(sample_texts(docs, text_col))
    rows = docs.select(column(docs, id_col).cast("long").alias("doc_id"),
                       column(docs, text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan(params, least), (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"))
