import hashlib

import duckdb
import pytest

from brookmart.llm import decontaminate as dc
from brookmart.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def slow_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in low).split(" ")


def expected(texts, items):
    wins = {}
    for key, text in items:
        w = [x for x in slow_words(text) if x]
        for i in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[i:i + 10]), set()).add("" if key is None else str(key))
    out = []
    for text in texts:
        w, hit, found = [x for x in slow_words(text) if x], set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                if k in wins:
                    hit.update(range(i, i + n))
                    found |= wins[k]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def actual(frame):
    return sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect())


@pytest.mark.parametrize("block", [200_000, 150])
def test_against_brute_force(spark, docs, odd, block):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    items = [(r.item_id, r.text) for r in items] + [(900, None), (901, ""), (902, "Same Words, in the"), (903, "one"),
                                                    (903, "one"), (None, "null id here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for frame in (docs, odd):
        texts = [r.text for r in frame.select("text").collect()]
        for size in (1_000_000, 3000):
            got = dc.search(dc.build_index(frame, segment_words=size), bench, block=block)
            assert actual(got) == expected(texts, items)


def test_near_but_not_exact(spark):
    item = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    texts = [(1, "x " * 20 + "alpha beta gamma delta epsilon zeta NEW eta theta iota kappa" + " y" * 20),
             (2, "x " * 20 + "alpha beta gamma" + " y" * 40)]
    index = dc.build_index(spark.createDataFrame(texts, "doc_id long, text string"))
    got = {r.doc_id: r for r in dc.search(index, spark.createDataFrame(item, "item_id long, text string")).collect()}
    assert (got[1].n_hit, got[1].n_near_items) == (0, 1)
    assert (got[2].n_hit, got[2].n_near_items) == (0, 0)


def test_near_at_the_edges_of_documents(spark):
    item = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    near = "alpha beta gamma delta epsilon zeta NEW eta theta iota kappa"
    texts = [(1, near + " y" * 40), (2, "x " * 40 + near), (3, near + " y"), (4, near),
             # halves in neighbouring documents are no match
             (5, "x " * 40 + "alpha beta gamma delta epsilon"), (6, "zeta eta theta iota kappa" + " y" * 40)]
    index = dc.build_index(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1))
    got = dc.search(index, spark.createDataFrame(item, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_hit, r.n_near_items) for r in got} == {
        1: (0, 1), 2: (0, 1), 3: (0, 1), 4: (0, 1), 5: (0, 0), 6: (0, 0)}


def test_without_items_or_documents(spark, odd, none):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert dc.search(dc.build_index(none), bench).count() == 0
    assert dc.search(dc.build_index(odd), bench.limit(0)).filter("contaminated").count() == 0
    assert dc.decontaminate(odd, bench.limit(0)).count() == odd.count()


def test_contaminated_rows_go(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in dc.search(dc.build_index(docs), bench).filter("contaminated").collect()}
    left = dc.decontaminate(docs, bench)
    assert bad and left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_near_matches_against_the_twin(spark, docs):
    """Items put into texts with words added, taken out of place or put far apart."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()[["item_id", "text"]]
    rows = [(r.doc_id, r.text) for r in docs.limit(40).collect()]
    for i, text in enumerate(bench.text[:20]):
        w = dc.words(text.encode())
        w = [x.decode() for x in w]
        for kind, said in enumerate((w[:5] + ["new"] + w[5:], w[::-1], w[:5] + ["far"] * (5 * i) + w[5:], w[1:])):
            rows.append((10_000 + 10 * i + kind, " ".join(["x"] * (i % 3) + said)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dc.search(dc.build_index(frame, segment_words=3000), spark.createDataFrame(bench)).drop("items").toPandas()
    db = duckdb.connect()
    db.register("documents", frame.toPandas())
    db.register("benchmark", bench)
    want = db.sql(ORACLE["op10_decontaminate"]).df()[list(got.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    assert (got.n_near_items > got.n_items).sum() >= 20 and (got.n_near_items == 0).any()
