import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from brookmart.llm import packing, tokens
from brookmart.llm.common import crc32_ids
from brookmart.llm.tokens import Encoder, encoder, vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def check_places(rows, capacity):
    """rows: (bin, offset, length); no gaps, no overlaps, nothing beyond the capacity."""
    bins = {}
    for b, offset, length in rows:
        bins.setdefault(b, []).append((offset, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_places(docs, odd):
    tokens = encoder(PATH, True).tokenizer
    for frame in (docs, odd):
        got = packing.pack(frame, PATH).collect()
        want = []
        for r in frame.collect():
            ids = tokens.encode(r.text or "", add_special_tokens=False).ids + [2]
            first = len(ids) % 1024 or 1024
            cuts = [0, *range(first, len(ids) + 1, 1024)]
            want += [(str(r.doc_id), k, a, b - a, crc32_ids(np.array(ids[a:b])))
                     for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
        n = check_places([(r.sequence_id, r.offset, r.length) for r in got], 1024)
        assert n <= 1.03 * -(-sum(r.length for r in got) // 1024) + 1
        for r in got:
            assert crc32_ids(np.frombuffer(r.ids, "<u2")) == r.ids_crc32


def test_a_full_memory_keeps_what_is_in_use(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 6)
    for path, spaces in ((PATH, True), (vocabulary("word_bpe_49k.json"), False)):
        one, learnt = Encoder(path, spaces), []
        learn = one._learn
        one._learn = lambda runs: (learnt.extend(runs), learn(runs))[1]
        for text in ("in a one two", "in a three four", "in a five six seven", "in a one"):
            assert [x.tolist() for x in one.encode([text])] == one._encode([text])
        words = [r.strip() for r in learnt if r.strip()]
        assert words.count("in") == words.count("a") == 1 and words.count("one") == 2


def test_words_and_the_marks_after_them():
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
    texts = [f"word{a}{b} Été{a}{b}{a} x{b}y it's{a} don't{b} 's{a}" for a in marks for b in marks]
    for path, spaces in ((PATH, True), (vocabulary("word_bpe_49k.json"), False)):
        one = Encoder(path, spaces)
        assert [x.tolist() for x in one.encode(texts)] == one._encode(texts)


def test_marks_are_cut_off_before_words_are_remembered():
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    words = ["word", "Été", "straße", "ñ", "ª", "Āį"]
    texts = [f"a {w}{m}" for w in words for m in marks] + [f"a {w}" for w in words]
    for path, spaces in ((PATH, True), (vocabulary("word_bpe_49k.json"), False)):
        one = Encoder(path, spaces)
        assert [x.tolist() for x in one.encode(texts)] == one._encode(texts)
        assert {r.strip() for r in one.known if r.strip()} == {"a", *words, *marks}


def test_a_mark_is_cut_off_after_latin_letters_only():
    # the bytes before these marks end letters, or look like parts of them
    texts = [f"{c}{d}" for c in "é×÷…–½²٣中жſΣ̸́9\u2019" for d in (".", ".x", "≠", "='s", "..")] + [".", "é", None, ". é", "é.x"]
    for path, spaces in ((PATH, True), (vocabulary("word_bpe_49k.json"), False)):
        one = Encoder(path, spaces)
        assert [x.tolist() for x in one.encode(texts)] == one._encode([t or "" for t in texts])


def test_nothing(none):
    assert packing.pack(none, PATH).count() == 0


def test_many_ranges_are_as_good_as_one(spark):
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in rng.integers(1, 101, 1500)] + [3] * 300
    frame = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    used = []
    for rows in (150, 100_000):
        got = packing.place(frame, 100, rows).collect()
        assert sorted(r.id for r in got) == list(range(len(sizes)))
        used.append(check_places([(r.bin, r.offset, sizes[r.id]) for r in got], 100))
    assert used[0] <= 1.02 * used[1] + 2 and used[1] <= 1.02 * -(-sum(sizes) // 100) + 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(20, 30))
def test_sweep_is_best_fit_decreasing(sizes, capacity):
    rows = [(s, True, i) for i, s in enumerate(sorted(sizes, reverse=True))]
    placed = list(packing.sweep(iter(rows), capacity, opens=True))
    check_places([(b, o, s) for kind, _, s, b, o in placed if kind == packing.PLACED], capacity)
    rooms, bins = [], 0
    for s, *_ in rows:
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            bins += 1
            rooms.append(capacity - s)
    assert len({b for kind, _, _, b, _ in placed if kind == packing.PLACED}) == bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 9), st.integers(0, 5), st.integers(9, 30)), max_size=6))
def test_flows_give_each_piece_one_gap_that_holds_it(ranges):
    rows = [(i, n, most, g, room) for i, (n, most, g, room) in enumerate(ranges)]
    taken, served = {}, set()
    for part, lo, hi, gap_part, first, each in packing.flows(rows):
        assert gap_part < part and hi <= rows[part][1]
        for k in range(lo, hi):
            assert (part, k) not in served
            served.add((part, k))
            gap = gap_part, first + (k - lo) // each
            assert gap[1] < rows[gap_part][3]
            taken[gap] = taken.get(gap, 0) + rows[part][2]
            assert taken[gap] <= rows[gap_part][4]
