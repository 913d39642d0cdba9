import duckdb
import pytest

from brookmart.llm import collocations as C
from brookmart.llm.oracle import collocations_sql

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def slow(rows, support, top=2000, longest=5):
    """All counts in memory, by the definition."""
    import re
    from collections import Counter
    from itertools import groupby

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n, out = Counter(), Counter(), []
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", *words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if a >= support and len(p) > 2}
    for (lang, *w), a in found.items():
        if any(len(v) > len(w) + 1 and v[0] == lang and b >= a and any(
                list(v[i:i + len(w)]) == w for i in range(1, len(v) - len(w) + 1)) for v, b in found.items()):
            continue
        score, k, left, right = min(
            (1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]])
            for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, left, right, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    return [(lang, i, *x[1:]) for lang, some in groupby(out, key=lambda x: x[0])
            for i, x in enumerate(some, 1) if i <= top]


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


TEXTS = [
    ("en", "The quick brown fox, the quick brown fox. A quick brown dog"), ("en", "the Quick\tbrown  fox; the quick"),
    ("en", "the\nquick brown fox\x0bthe quick brown cat"), (None, "eins zwei drei eins zwei drei eins zwei"),
    ("und", "eins zwei drei, eins zwei"), ("de", "aa aa aa aa aa aa"), ("de", "é É é É ß\xa0x ß\xa0x ß\xa0x"),
    ("en", None), ("en", ""), ("en", " .,;:!?\n\r\t"), ("de", "a\x00b c\x1cd a\x00b c\x1cd a\x00b c\x1cd"),
]


@pytest.mark.parametrize("parts, block_bytes", [(1, 6_000_000), (3, 40), (7, 1)])
def test_as_by_hand(spark, parts, block_bytes):
    docs = spark.createDataFrame(TEXTS * 3, "lang string, text string").repartition(parts)
    want = slow(TEXTS * 3, 4)
    assert want and rows_of(C.collocations(docs, support=4, block_bytes=block_bytes)) == want


def test_many_shards_lose_nothing(spark, docs):
    """Support shared out among sixteen shards, against SQL over the whole table."""
    db = duckdb.connect()
    db.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = db.sql(collocations_sql(support=5, top=150)).fetchall()
    got = C.collocations(docs.repartition(16), support=5, top=150, block_bytes=20_000)
    assert len(want) > 200 and rows_of(got) == sorted(want, key=lambda r: (r[0], r[1]))


def test_a_phrase_in_one_shard_only_is_found(spark):
    rows = [("en", " ".join(f"w{i}x{j}" for j in range(30))) for i in range(40)] + [("en", "rare pair. " * 6)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1).repartition(8)
    assert [r.phrase for r in C.collocations(docs, support=6).collect()] == ["rare pair"]


def test_exact_beyond_64_bits(spark):
    """The product in a score, and its divisor, pass 64 bits."""
    n = 9_000_000_000_000
    df = spark.createDataFrame([(3_000_000_019, n, 4_000_000_007, 5_000_000_029)], "a long, n long, l long, r long")
    got = df.selectExpr("cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(19,0)) "
                        "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").first()[0]
    assert got == 1000 * 3_000_000_019 * n // (4_000_000_007 * 5_000_000_029)


def test_bit_map_has_all(spark):
    import numpy as np
    rows = [(i * 7919 - 2 ** 62, i % 3) for i in range(5000)]
    bits = C.bit_map(spark.createDataFrame(rows, "h long, salt int").repartition(4))
    for salt in range(3):
        h = np.array([h for h, s in rows if s == salt], np.int64).view(np.uint64)
        assert C.has(bits, h, salt).all()
    others = np.random.default_rng(1).integers(0, 2 ** 63, 20_000).astype(np.uint64)
    assert C.has(bits, others, 1).mean() < 0.1


def test_odd_rows_and_none(spark, odd, none):
    got = rows_of(C.collocations(odd, support=2))
    assert got == slow([(r.lang, r.text) for r in odd.collect()], 2)
    assert rows_of(C.collocations(none)) == []
