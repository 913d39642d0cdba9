import base64
import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from brookmart.llm import secrets


def slow_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(secrets.ASSIGN, text, re.I | re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_base_against_plain_patterns(docs, odd):
    for frame in (docs, odd):
        want = sorted((str(r.doc_id), hashlib.sha256(slow_spans(r.text or "").encode()).hexdigest())
                      for r in frame.collect())
        got = secrets.scan(frame).collect()
        assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
        for r in got:
            kinds = [s.split(":")[0] for s in r.spans.split(",")] if r.spans else []
            assert [r.n_assign, r.n_access, r.n_hex, r.n_novel] == [kinds.count(k) for k in secrets.KINDS]


def test_odd_letters_and_failing_matches():
    text = "ſecret=abcdefghijklmnop TOKEN:'short' Api_Key = \"0123456789abcdefXY\" AKIAAKIA AKIA0123456789ABCD é 0123456789abcde"
    data = text.encode()
    got = ",".join(f"{k}:{s}:{e}" for s, e, k in secrets.base_spans(text, data, data.lower()))
    assert got == slow_spans(text) and "hex" in got and "access" in got


def test_new_strings_after_sensitive_words(docs):
    primed = secrets.compressor(secrets.train_dictionary(docs))
    prose = docs.filter("length(text) > 2000").first().text[:1500]
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(50):
        key = base64.b64encode(rng.bytes(24)).decode()
        text = f"{prose[:700]} the private key {key} {prose[700:]}"
        at = text.index(key)
        spans = secrets.spans_of(text, primed)[1]
        found += (at, at + len(key), "novel") in spans
        assert secrets.spans_of(f"{prose[:700]} {key} {prose[700:]}", primed)[1] == []
        assert secrets.spans_of(f"{prose} auth my_user_name_2 and private long_parameter_name_v2 x", primed)[1] == []
    assert found >= 48


def test_secret_shared_by_a_large_group_of_near_copies(spark, docs):
    rng = np.random.default_rng(4)
    texts = [r.text for r in docs.filter("length(text) BETWEEN 1500 AND 20000").limit(60).collect()]
    keys = [base64.b64encode(rng.bytes(30)).decode() for _ in range(4)]
    shared, single, far, plain = keys
    rows = [f"{texts[0][:1200]} copy {i} the private key {shared} {texts[0][1200:]}" for i in range(60)]
    # a secret that other texts hold without a sensitive word, or on another line than the word
    rows += [f"{texts[1][:600]} copy {i} see {far} {texts[1][600:]} private key:\n{plain}" for i in range(60)]
    rows += [f"{texts[2]} the private key {k} {texts[3]}" for k in (single, far, plain)] + texts[4:]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.scan(frame).collect()}
    for i, text in enumerate(rows[:60] + rows[120:123]):
        key = next(k for k in (shared, single, far, plain) if k in text)
        i, at = i if i < 60 else i + 60, text.index(key)
        assert f"novel:{at}:{at + len(key)}" in got[i].split(",")


def test_secret_that_stands_twice(docs):
    primed = secrets.compressor(secrets.train_dictionary(docs))
    prose = docs.filter("length(text) > 2000").first().text
    rng = np.random.default_rng(6)
    found = places = 0
    for n in range(40):
        key = base64.b64encode(rng.bytes(24)).decode()
        # adjacent lines, with a mark joined to one of them, and cut by the edge of the surroundings
        text = (f"{prose[:300]}\nprivate_key={key}\nauth {key}\n{prose[300:300 + 330 + n]} auth {key}"
                f" {prose[700:900]}")
        spans = secrets.spans_of(text, primed)[1]
        for m in re.finditer(re.escape(key), text):
            places += 1
            found += any(s <= m.start() and m.end() <= e for s, e, _ in spans)
    assert places == 120 and found >= 0.95 * places


def test_redaction(odd, none):
    kept = secrets.redact(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    (row,) = kept.filter("doc_id = -3").collect()
    assert row.text.startswith("[SECRET] +1 (222)") and row.n_chars == len(row.text)
    assert secrets.redact(none).count() == secrets.scan(none).count() == 0
    assert secrets.hidden("abcdef", [(1, 3, "x"), (2, 4, "y")], "*") == "a*ef"


def test_very_long_strings_take_time_in_proportion(docs):
    import time
    primed = secrets.compressor(secrets.train_dictionary(docs))
    blob = base64.b64encode(np.random.default_rng(3).bytes(3_000_000)).decode()
    for text, found in ((f"the private key {blob} end", 1), ("key1" * 100_000, 0), ("key " * 100_000, 0)):
        begin = time.process_time()
        spans = secrets.spans_of(text, primed)[1]
        assert time.process_time() - begin < 30
        # a blob is one span, but for what the fixed patterns find inside it
        assert len([x for x in spans if x[1] - x[0] > 10_000]) == found or spans and found


def test_longer_keys_are_found(docs):
    primed = secrets.compressor(secrets.train_dictionary(docs))
    prose = docs.filter("length(text) > 2000").first().text[:1500]
    rng = np.random.default_rng(4)
    for size in (96, 300, 1200):
        key = base64.b64encode(rng.bytes(size)).decode()
        text = f"{prose[:700]} the private key {key} {prose[700:]}"
        at = text.index(key)
        assert (at, at + len(key), "novel") in secrets.spans_of(text, primed)[1]
        path = "/".join(prose.split()[:size // 6])
        assert secrets.spans_of(f"{prose[:700]} private {path} {prose[700:]}", primed)[1] == []


def test_every_text_is_learned_from(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(12000)]
    rows = [" ".join(rng.choice(words[:2000], 60)) for _ in range(1000)]
    # frequent in texts longer than any that a sample took
    phrase = "the quick settlement of our quarterly ledger comes before all other business"
    rows += [" ".join(rng.choice(words[2000:], 3000)) + " " + " ".join([phrase] * 3) for _ in range(60)]
    frame = spark.createDataFrame([(x,) for x in rows], "text string")
    learned = secrets.train_dictionary(frame)
    assert b"quarterly ledger" in learned
    # whatever the order and the partitions
    assert secrets.train_dictionary(frame.orderBy(F.xxhash64("text")).repartition(3)) == learned
