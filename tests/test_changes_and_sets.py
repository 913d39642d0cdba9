"""Changes in commit order, days as bitmaps, and the stored word index."""

import itertools
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from brookmart.operators import routing
from brookmart.schemas import USER_INFO
from brookmart.session import work_dir
from brookmart.sinks import bitmaps, buckets, ordered, postings


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


# -- changes ---------------------------------------------------------------

def message(kind, ts, xid, level, id="7", **place):
    return json.dumps({"type": kind, "table": "user_info", "ts": ts, "xid": xid, **place,
                       "data": {"id": id, "user_level": level}})


def applied(spark, path, batch, values):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset bigint")
    routed = routing.with_commit(routing.route_maxwell(rows).withColumn("key", routing.row_key()))
    assert {r.key for r in routed.collect()} <= {"7", "8"}
    return ordered.apply(ordered.parse(routed, USER_INFO), path, batch, USER_INFO, ["id"], n=2)


def now(spark, path):
    return {r.id: r.user_level for r in ordered.read(spark, path, USER_INFO, ["id"]).collect()}


HISTORY = [message("insert", 5, 50, "1", xoffset=0), message("update", 5, 50, "2", commit=True),
           message("delete", 5, 51, "2", commit=True)]
AGAIN = message("insert", 6, 52, "3", commit=True)


@pytest.mark.parametrize("steps", list(itertools.permutations(range(3))))
def test_any_order_of_arrival_ends_in_the_same_table(spark, steps):
    """Insert, update and delete in one batch and one by one; then a later insert."""
    changes = [HISTORY[i] for i in steps]
    one, each = work_dir(spark, "one"), work_dir(spark, "each")
    other = message("insert", 1, 1, "9", id="8", commit=True)
    applied(spark, one, 0, [other, *changes, changes[0]])
    for i, c in enumerate(changes):
        assert applied(spark, each, i, [other, c])
    assert now(spark, one) == now(spark, each) == {"8": "9"}
    assert not applied(spark, each, 2, [AGAIN])  # that batch is there
    assert applied(spark, each, 3, [AGAIN]) and applied(spark, each, 4, [HISTORY[1]])
    assert now(spark, each) == {"7": "3", "8": "9"}


def test_updates_of_one_transaction_keep_their_places(spark):
    path = work_dir(spark, "t")
    last = message("update", 5, 50, "c", commit=True)
    applied(spark, path, 0, [last, message("update", 5, 50, "b", xoffset=1), message("insert", 5, 50, "a", xoffset=0)])
    assert now(spark, path) == {"7": "c"}


def test_tombstones_outlive_merges_until_forgotten(spark, monkeypatch):
    monkeypatch.setattr(buckets, "FOLDERS", 2)
    schema = spark.createDataFrame([], "id string, v int").schema

    def batch(path, i, ts, deleted, forget=None):
        rows = spark.createDataFrame([("a", i, ts, 0, 0, 0, deleted)],
                                     "id string, v int, _ts int, _xid int, _xoffset int, _offset int, _deleted boolean")
        ordered.apply(rows, path, i, schema, ["id"], n=1, forget_before=forget)
        return [r.v for r in ordered.read(spark, path, schema, ["id"]).collect()]

    path = work_dir(spark, "t")
    assert batch(path, 0, 100, False) == [0] and batch(path, 1, 200, True) == []
    for i in range(2, buckets.FOLDERS + 4):
        assert batch(path, i, 150, False) == []
    path = work_dir(spark, "t")
    assert batch(path, 0, 100, True) == []
    for i in range(1, buckets.FOLDERS + 4):
        batch(path, i, 50, True, forget=101)
    assert batch(path, 99, 60, False, forget=101) == [99]


def test_unknown_commits_go_by_batch_and_offset(spark):
    path = work_dir(spark, "t")
    plain = [json.dumps({"type": "update", "table": "user_info", "data": {"id": "7", "user_level": v}}) for v in "ab"]
    applied(spark, path, 0, plain)
    assert now(spark, path) == {"7": "b"}
    applied(spark, path, 1, plain[:1])
    assert now(spark, path) == {"7": "a"}


def test_canal_rows_and_facts_bear_no_commit(spark):
    rows = spark.createDataFrame([('{"type":"INSERT","table":"user_info","data":[{"id":1}]}',)], "value string")
    assert [r.value for r in routing.with_commit(routing.route_canal(rows)).collect()] == ['{"id":1}']
    rows = spark.createDataFrame([('{"type":"insert","ts":4,"table":"order_info","data":{"id":1}}',)], "value string")
    assert [r.value for r in routing.with_commit(routing.route_maxwell(rows)).collect()] == ['{"id":1}']


# -- days ------------------------------------------------------------------

def test_bitmaps_count_like_sets(spark):
    """Days come late and in any order, rows are repeated, a batch runs again."""
    path, dice = work_dir(spark, "days"), random.Random(3)
    days = [f"2024-{m:02}-{d:02}" for m in (1, 2, 3) for d in (1, 2, 30)]
    want = {}
    for i in range(4):
        rows = [(dice.choice(days), f"m{dice.randrange(40)}") for _ in range(30)]
        batch = spark.createDataFrame([*rows, *rows[:5], (None, "x"), (days[0], None)], "dt string, member string")
        assert bitmaps.add(batch, path, i, n=3) and not bitmaps.add(batch, path, i, n=3)
        for d, m in rows:
            want.setdefault(d, set()).add(m)
    got = {r.dt: (r.n, r.n_new) for r in bitmaps.by_day(spark, path).collect()}
    before, expected = set(), {}
    for d in sorted(want):
        expected[d] = (len(want[d]), len(want[d] - before))
        before |= want[d]
    assert got == expected
    for d in days[::3]:
        assert [tuple(r) for r in bitmaps.of_day(spark, path, d).collect()] == [
            (d, *expected[d]) for _ in [0] if d in expected]
    assert bitmaps.of_day(spark, path, "2023-05-05").count() == 0


def test_numbers_are_given_once_and_without_gaps(spark):
    path = work_dir(spark, "days")
    first = spark.createDataFrame([(f"m{i}",) for i in range(50)], "member string")
    more = spark.createDataFrame([(f"m{i}",) for i in range(25, 90)], "member string")
    one = {r.member: r.number for r in bitmaps.numbers(first, path, 0, n=3).collect()}
    assert one == {r.member: r.number for r in bitmaps.numbers(first, path, 0, n=3).collect()}
    two = {r.member: r.number for r in bitmaps.numbers(more, path, 1, n=3).collect()}
    assert all(two[m] == one[m] for m in one.keys() & two.keys())
    every = sorted((one | two).values())
    assert len(every) == len(set(every)) == 90
    ends = [i for i, v in enumerate(every) if v % bitmaps.STRIDE == 0]
    assert len(ends) == 3 and all(b - a == 1 for a, b in zip(every, every[1:]) if b % bitmaps.STRIDE)


def test_a_day_reads_months_instead_of_older_days(spark):
    path = work_dir(spark, "days")
    rows = [(f"2023-{m:02}-{d:02}", f"m{m}") for m in range(1, 13) for d in range(1, 29)]
    bitmaps.add(spark.createDataFrame(rows, "dt string, member string"), path, 0)
    text = plan(bitmaps.of_day(spark, path, "2023-12-03"))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(period,2023-12-03\)", text)
    assert [tuple(r) for r in bitmaps.of_day(spark, path, "2023-12-01").collect()] == [("2023-12-01", 1, 1)]
    assert [tuple(r) for r in bitmaps.of_day(spark, path, "2023-12-02").collect()] == [("2023-12-02", 1, 0)]


# -- words -----------------------------------------------------------------

def tokens(text):
    return [w for w in re.split(r"[^a-z0-9]+", (text or "").lower()) if w]


def scores(docs, asked):
    """BM25 over all documents, plainly."""
    split = {k: tokens(t) for k, t in docs.items()}
    mean = sum(map(len, split.values())) / len(split)
    out = {}
    for w in {a.lower() for a in asked}:
        df = sum(w in t for t in split.values())
        for k, t in split.items():
            if w in t:
                n, k1, b = t.count(w), postings.K, postings.B
                out[k] = out.get(k, 0) + math.log(1 + (len(split) - df + 0.5) / (df + 0.5)) * n * (k1 + 1) / (
                    n + k1 * (1 - b + b * len(t) / mean))
    return sorted(((k, round(s, 6)) for k, s in out.items()), key=lambda r: (-r[1], r[0]))


def test_search_equals_scores_of_all_texts(spark):
    path, dice = work_dir(spark, "index"), random.Random(5)
    docs = {}
    for i in range(3):
        batch = {dice.randrange(30): " ".join(dice.choice(["a", "B", "c", "the", "x,y"]) for _ in range(dice.randrange(40)))
                 for _ in range(12)}
        batch[100 + i] = None
        rows = spark.createDataFrame(list(batch.items()), "id int, body string")
        assert postings.add(rows, path, i, "id", "body", n=3) and not postings.add(rows, path, i, "id", "body", n=3)
        docs |= batch
        for asked in (["THE"], ["a", "A", "x"], ["none"], [])[:4 if i == 2 else 1]:
            got = [(r.doc, pytest.approx(r.score, abs=2e-6)) for r in postings.search(spark, path, asked, 50).collect()]
            assert scores(docs, asked) == got
    assert len(postings.search(spark, path, ["the", "a"], 3).collect()) == 3


def test_an_index_without_documents(spark):
    path = work_dir(spark, "index")
    assert postings.search(spark, path, ["a"]).count() == 0
    postings.add(spark.createDataFrame([], "id bigint, body string"), path, 0, "id", "body")
    assert postings.search(spark, path, ["a"]).count() == 0


def test_a_batch_that_failed_between_its_tables(spark, monkeypatch):
    path = work_dir(spark, "index")
    one = spark.createDataFrame([(1, "a b"), (2, "b")], "id bigint, body string")
    two = spark.createDataFrame([(1, "c"), (3, "b c")], "id bigint, body string")
    postings.add(one, path, 0, "id", "body")
    real, left = buckets.upsert, [1]

    def failing(rows, place, *args, **named):
        if place.endswith(stop) and left:
            left.pop()
            raise RuntimeError(stop)
        return real(rows, place, *args, **named)

    for i, stop in enumerate(("/totals", "/texts")):
        left[:] = [1]
        monkeypatch.setattr(buckets, "upsert", failing)
        with pytest.raises(RuntimeError):
            postings.add(two, path, 1 + i, "id", "body")
        assert postings.add(two, path, 1 + i, "id", "body")
        monkeypatch.undo()
    docs = {1: "c", 2: "b", 3: "b c"}
    for asked in (["a"], ["b"], ["c", "b"]):
        got = [(r.doc, pytest.approx(r.score, abs=2e-6)) for r in postings.search(spark, path, asked).collect()]
        assert scores(docs, asked) == got


def test_a_search_reads_the_folders_of_its_words(spark):
    path = work_dir(spark, "index")
    rows = spark.range(200).select(F.col("id"), F.concat(F.lit("word w"), F.col("id")).alias("body"))
    postings.add(rows, path, 0, "id", "body", n=16)
    read = {int(f.split(f"/{buckets.BUCKET}=")[1].split("/")[0]) for f in postings.postings(spark, path, ["w5"]).inputFiles()}
    assert len(read) == 1
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,w5)]" in plan(postings.postings(spark, path, ["w5"]))


def test_words_are_counted_without_a_shuffle(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b", "é", "a", "b"]), (2, []), (3, ["x"])], "doc bigint, w array<string>")
    rows = rows.withColumn("length", F.size("w").cast("bigint"))
    made = postings._made(rows, spark.createDataFrame([], postings.TEXTS))
    assert "hashpartitioning(term" not in plan(made) and "Aggregate" not in plan(made)
    assert sorted((r.doc, r.term, r.n, r.length) for r in made.collect()) == [
        (1, "a", 2, 6), (1, "b", 3, 6), (1, "é", 1, 6), (3, "x", 1, 1)]
    # a document that a batch holds twice counts with all its words, as before
    path = work_dir(spark, "index")
    postings.add(spark.createDataFrame([(1, "a b a"), (1, "a"), (None, "a"), (2, "b")], "id bigint, body string"), path, 0, "id", "body")
    got = sorted((str(r.doc), r.n, r.length) for r in postings.postings(spark, path, ["a"]).collect())
    assert got == [("1", 3, 3), ("None", 1, 1)]
