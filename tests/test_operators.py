import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from brookmart.operators import devices, firstorder, hot, keyed, lookups, orderwide, reports, routing
from brookmart.sources import tables

few = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


# -- routing ---------------------------------------------------------------

def test_route_logs_edges(spark):
    rows = spark.createDataFrame([
        ('{"start":{},"ts":1}',), ('{"start":null}',), ('{"page":{}}',), ('{"start":{"entry":"icon"}}',),
    ], "value string")
    got = [r.topic for r in routing.route_logs(rows).collect()]
    assert got == ["start_log", "event_log", "event_log", "start_log"]


def test_route_canal(spark):
    rows = spark.createDataFrame([
        ('{"type":"INSERT","table":"order_info","data":[{"id":1},{"id":2,"x":{"y":3}}]}',),
        ('{"type":"insert","table":"order_info","data":[{"id":9}]}',),
        ('{"type":"UPDATE","table":"order_info","data":[{"id":9}]}',),
        ('{"type":"INSERT","table":"anything","data":[]}',),
    ], "value string")
    got = sorted(tuple(r) for r in routing.route_canal(rows).collect())
    assert got == [("ods_order_info", '{"id":1}'), ("ods_order_info", '{"id":2,"x":{"y":3}}')]


def test_route_maxwell(spark):
    rows = spark.createDataFrame([(v,) for v in (
        '{"type":"insert","table":"order_info","data":{"id":1}}',
        '{"type":"update","table":"order_info","data":{"id":2}}',
        '{"type":"INSERT","table":"order_detail","data":{"id":3}}',
        '{"type":"delete","table":"user_info","data":{"id":4}}',
        '{"type":"bootstrap-insert","table":"spu_info","data":{"id":5}}',
        '{"type":"insert","table":"comment_info","data":{"id":6}}',
        '{"type":"insert","table":"order_info","data":{}}',
        '{"type":"insert","table":"order_info","data":{ }}',
        '{"type":"insert","table":"order_info"}',
        '{"type":"insert","table":"order_info","data":null}',
    )], "value string")
    got = sorted((r.topic, r.value) for r in routing.route_maxwell(rows).collect())
    assert got == [("ods_order_info", '{"id":1}'), ("ods_spu_info", '{"id":5}'), ("ods_user_info", '{"id":4}')]


# -- devices ---------------------------------------------------------------

def log(mid, ts, offset, **common):
    inside = ",".join(f'"{k}":"{v}"' for k, v in ({"mid": mid} if mid else {} | common).items())
    return (offset, f'{{"common":{{{inside}}},"start":{{}},"ts":{ts}}}')


def test_first_seen_over_midnight_and_ties(spark):
    rows = [log("a", 1616543999999, 5), log("a", 1616544000000, 6), log("a", 1616543999999, 4), log(None, 1616543999999, 1)]
    seen = devices.first_seen(devices.flatten(devices.parse_logs(spark.createDataFrame(rows, "offset bigint, value string"))))
    got = {(r.dt, r.mid, r.hr, r.mi): r.offset for r in seen.collect()}
    assert got == {("2021-03-23", "a", "23", "00"): 4, ("2021-03-24", "a", "00", "00"): 6,
                   ("2021-03-23", None, "23", "00"): 1}


@few
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30),
       st.randoms())
def test_first_seen_ignores_order_and_repeats(spark, rows, rnd):
    rows = [(d, m, t, i) for i, (d, m, t) in enumerate((k, str(m), t) for k, m, t in rows)]
    frame = spark.createDataFrame(rows, "dt string, mid string, ts int, offset int")
    want = {}
    for r in rows:
        key = r[:2]
        want[key] = min(want.get(key, r[2:]), r[2:])
    mixed = rows[:]
    rnd.shuffle(mixed)
    once = devices.first_seen(frame)
    for result in (once, devices.first_seen(once), devices.first_seen(
            spark.createDataFrame(mixed + mixed, frame.schema))):
        assert {(r.dt, r.mid): (r.ts, r.offset) for r in result.collect()} == want


def test_new_devices_counts_first_days(spark):
    rows = spark.createDataFrame([("a", "d1"), ("a", "d2"), ("b", "d2"), ("c", "d2")], "mid string, dt string")
    assert {r.dt: r.n for r in devices.new_devices(rows).collect()} == {"d1": 1, "d2": 2}


# -- first orders ----------------------------------------------------------

ORDER = "id bigint, user_id bigint, create_time string"


def test_first_order_ties_and_history(spark):
    orders = spark.createDataFrame([
        (2, 10, "2021-01-01 00:00:00"), (1, 10, "2021-01-01 00:00:00"), (3, 10, "2020-12-31 23:59:59"),
        (5, 11, "2021-01-02 00:00:00"), (4, 11, "2021-01-02 00:00:00"),
        (6, 12, "2021-01-03 00:00:00"),
    ], ORDER)
    status = spark.createDataFrame([("12", "0")], "user_id string, if_consumed string")
    marked = firstorder.mark_first_orders(orders, status)
    assert {r.id: r.if_first_order for r in marked.collect()} == {1: "0", 2: "0", 3: "1", 4: "1", 5: "0", 6: "0"}
    assert sorted(tuple(r) for r in firstorder.user_status(marked).collect()) == [("10", "1"), ("11", "1")]


@few
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), min_size=1, max_size=25))
def test_one_first_order_per_user(spark, rows):
    orders = spark.createDataFrame([(i, u, f"t{t}") for i, (u, t) in enumerate(rows)], ORDER)
    marked = firstorder.mark_first_orders(orders).collect()
    assert len(marked) == len(rows)
    assert sorted(r.user_id for r in marked if r.if_first_order == "1") == sorted({u for u, _ in rows})


# -- lookups ---------------------------------------------------------------

def test_lookup_misses_give_nulls(spark):
    orders = spark.createDataFrame([(1, 1), (2, 99), (3, None)], "id bigint, province_id bigint")
    dim = spark.createDataFrame([("1", "N", "010", "CN-1")], "id string, name string, area_code string, iso_code string")
    got = {r.id: (r.province_name, r.province_area_code) for r in lookups.with_province(orders, dim).collect()}
    assert got == {1: ("N", "010"), 2: (None, None), 3: (None, None)}


def test_sku_ids_that_are_no_numbers(spark):
    details = spark.createDataFrame([(1, 7), (2, 8), (3, 9)], "id bigint, sku_id bigint")
    skus = spark.createDataFrame([("7", "1", "x", "", "s", "t", "c"), ("8", None, "2", "3", "s", "t", "c")],
                                 "id string, spu_id string, tm_id string, category3_id string, "
                                 "spu_name string, tm_name string, category3_name string")
    got = {r.id: (r.spu_id, r.tm_id, r.category3_id, r.tm_name) for r in lookups.with_sku(details, skus).collect()}
    assert got == {1: (1, None, None, "t"), 2: (None, 2, 3, "t"), 3: (None, None, None, None)}


def test_sku_before_its_brand(spark):
    skus = spark.createDataFrame([("1", "2", "3", "4")], "id string, spu_id string, tm_id string, category3_id string")
    none = spark.createDataFrame([], "tm_id string, tm_name string")
    cats = spark.createDataFrame([("4", "cat")], "id string, name string")
    spus = spark.createDataFrame([("2", "spu")], "id string, spu_name string")
    r = lookups.denormalize_sku(skus, none, cats, spus).first()
    assert (r.tm_name, r.category3_name, r.spu_name) == (None, "cat", "spu")


def test_by_keys_gives_each_row_once(spark):
    dim = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    batch = spark.createDataFrame([(1,), (1,), (3,)], "user_id bigint")
    assert [tuple(r) for r in tables.by_keys(dim, "id", batch, "user_id").collect()] == [("1", "a")]


# -- allocation ------------------------------------------------------------

LINE = "order_id bigint, order_detail_id bigint, detail_amount double, original_total_amount double, final_total_amount double"


def by_hand(lines):
    """Running allocation in integer cents, line after line."""
    out, seen, given_sum = {}, {}, {}
    for order, line, amount, original, paid in sorted(lines):
        a, o, p = round(amount * 100), round(original * 100), round(paid * 100)
        before, already = seen.get(order, 0), given_sum.get(order, 0)
        if o == 0:
            share = None
        elif before + a == o and before != o:
            share = p - already
        else:
            share = (2 * p * a + o) // (2 * o)
        out[line] = share
        seen[order], given_sum[order] = before + a, already + (share or 0)
    return out


def finals(rows):
    return {r.order_detail_id: r.final_cents for r in rows.collect()}


@few
@given(st.lists(st.tuples(st.lists(st.integers(0, 5000), min_size=1, max_size=7), st.integers(0, 9999)),
                min_size=1, max_size=5))
def test_split_adds_up_to_what_was_paid(spark, orders):
    lines = [(o, o * 100 + i, a / 100, sum(amounts) / 100, paid / 100)
             for o, (amounts, paid) in enumerate(orders) for i, a in enumerate(amounts)]
    rows = spark.createDataFrame(lines, LINE)
    got = finals(orderwide.split_payment(rows))
    assert got == by_hand(lines)
    for o, (amounts, paid) in enumerate(orders):
        if sum(amounts):
            assert sum(got[o * 100 + i] for i in range(len(amounts))) == paid


def test_split_edges(spark):
    lines = [
        (1, 1, 0.0, 0.0, 5.0),                                           # nothing to divide by
        (2, 2, 1.0, 3.0, 1.0), (2, 3, 1.0, 3.0, 1.0), (2, 4, 1.0, 3.0, 1.0), (2, 5, 0.0, 3.0, 1.0),  # 0 after the end
        (3, 6, 1.0, 3.0, 1.0),                                           # never completes
        (4, 7, 2.0, 2.0, 2.0), (4, 8, 1.0, 2.0, 2.0),                    # more lines than the order says
    ]
    got = finals(orderwide.split_payment(spark.createDataFrame(lines, LINE)))
    assert got == {1: None, 2: 33, 3: 33, 4: 34, 5: 0, 6: 33, 7: 200, 8: 100}
    assert got == by_hand(lines)


def test_line_amount_is_price_times_number(spark):
    rows = spark.createDataFrame([(1, 1, 2.5, 4, 10.0, 9.0)], "order_id bigint, order_detail_id bigint, "
                                 "sku_price double, sku_num bigint, original_total_amount double, final_total_amount double")
    assert finals(orderwide.split_payment(rows)) == {1: 900}


def skewed_lines():
    rnd = random.Random(5)
    sizes = {1: 120, 2: 3, 3: 1, 4: 40, 5: 2}
    ids = list(range(1, 2000))
    rnd.shuffle(ids)
    lines = []
    for order, n in sizes.items():
        amounts = [rnd.randint(0, 300) for _ in range(n)]
        # order 4 states less than its lines add up to, so the end is inside
        total = sum(amounts) if order != 4 else sum(amounts)
        mine = sorted(ids.pop() for _ in range(n))
        if order == 4:
            total = sum(amounts[:25])
        lines += [(order, i, a / 100, total / 100, 77.77) for i, a in zip(mine, amounts)]
    return lines


def test_split_of_hot_orders_equals_plain(spark):
    """Orders cut into parts give what one window over them gives."""
    lines = skewed_lines()
    rows = spark.createDataFrame(lines, LINE)
    large = hot.hot_keys(rows, "order_id", more_than=10)
    assert {r.order_id: r._parts for r in large.collect()} == {1: 12, 4: 4}
    parted = hot.with_part(rows, "order_id", ["order_detail_id"], large)
    sizes = {(r.order_id, r._part): r["count"] for r in parted.groupBy("order_id", "_part").count().collect()}
    assert sizes[(2, hot.COLD)] == 3 and max(sizes.values()) < 40
    assert finals(orderwide.split_payment(parted, large)) == by_hand(lines)
    assert finals(orderwide.split_payment(rows)) == by_hand(lines)


def test_hot_orders_with_null_order_values_equal_plain(spark):
    rows = spark.createDataFrame([(1, None), (1, 1), (1, 2), (1, 3), (1, 4), (2, None), (2, -5)], "k int, v int")
    large = hot.hot_keys(rows, "k", more_than=2)
    one = {"n": F.lit(1), "s": F.coalesce(F.col("v"), F.lit(100))}
    plain = hot.running_sums(rows, "k", ["v"], one)
    parted = hot.running_sums(hot.with_part(rows, "k", ["v"], large), "k", ["v"], one, True).drop("_part")
    key = lambda f: sorted(map(repr, map(tuple, f.select("k", "v", "n", "s").collect())))
    assert key(plain) == key(parted)


def test_parts_are_of_equal_size_whatever_the_order_values(spark):
    """Of 3,000 rows of a key 2,999 have one order value, and half are equal altogether."""
    rows = spark.range(3000).select(
        F.lit(1).alias("k"), F.when(F.col("id") == 0, 1_000_000).otherwise(5).alias("v"),
        F.greatest(F.col("id"), F.lit(1500)).alias("x")).repartition(4)
    large = hot.hot_keys(rows, "k", more_than=100)
    parted = hot.with_part(rows, "k", ["v", "x"], large)
    sizes = [r["count"] for r in parted.groupBy("_part").count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 200 and sum(sizes) == 3000
    sums = {"n": F.lit(1), "s": F.col("x")}
    plain = hot.running_sums(rows, "k", ["v", "x"], sums)
    split = hot.running_sums(parted, "k", ["v", "x"], sums, True).drop("_part")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.none() | st.integers(-4, 4), st.integers(-9, 9)), min_size=30, max_size=90))
def test_parted_sums_equal_plain(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int, x int").repartition(3)
    large = hot.hot_keys(df, "k", more_than=7)
    sums = {"n": F.lit(1), "s": F.col("x")}
    plain = hot.running_sums(df, "k", ["v", "x"], sums)
    if large is None:
        return
    split = hot.running_sums(hot.with_part(df, "k", ["v", "x"], large), "k", ["v", "x"], sums, True).drop("_part")
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, split.collect()))


def test_no_hot_keys_is_none(spark):
    assert hot.hot_keys(spark.createDataFrame(skewed_lines(), LINE), "order_id") is None


@pytest.mark.parametrize("groups", [1, 4096])
def test_hot_keys_share_groups_with_others(spark, monkeypatch, groups):
    monkeypatch.setattr(hot, "GROUPS", groups)
    monkeypatch.setattr(hot, "GROUPS_EACH", 0)
    rows = spark.createDataFrame([(k,) for k in [1] * 7 + [None] * 8 + [2] * 3 + list(range(3, 60))], "k bigint")
    assert sorted(map(tuple, hot.hot_keys(rows, "k", more_than=3).collect()), key=str) == [(1, 3), (None, 3)]
    assert hot.hot_keys(rows, "k", more_than=8) is None


def test_split_continues_from_earlier_batches(spark):
    lines = skewed_lines()
    by_id = sorted(lines, key=lambda r: r[1])
    first, second = (spark.createDataFrame(part, LINE) for part in (by_id[:80], by_id[80:]))
    done = orderwide.split_payment(first)
    carried = done.groupBy("order_id").agg(F.max("amount_so_far").alias("amount_before"),
                                           F.max("given_so_far").alias("given_before"))
    large = hot.hot_keys(second, "order_id", more_than=10)
    rest = orderwide.split_payment(hot.with_part(second, "order_id", ["order_detail_id"], large), large, carried)
    assert finals(done) | finals(rest) == by_hand(lines)


def test_wide_join_with_hot_orders(spark):
    lines = skewed_lines()
    details = spark.createDataFrame([(i, o, a) for o, i, a, *_ in lines], "id bigint, order_id bigint, detail_amount double")
    orders = spark.createDataFrame([(o, f"s{o}") for o in range(1, 8)], "id bigint, order_status string")
    large = hot.hot_keys(details, "order_id", more_than=10)
    plain = orderwide.order_wide(orders, details)
    parted = orderwide.order_wide(orders, details, large).drop("_part")
    assert sorted(map(tuple, parted.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert plain.count() == len(lines)


# -- keyed -----------------------------------------------------------------

def test_last_per_key_keeps_whole_rows(spark):
    rows = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "b"), ("l", 1, "c", "d")],
                                 "k string, v int, x string, y string")
    got = sorted(map(tuple, keyed.last_per_key(rows, ["k"], ["v"]).collect()))
    assert got == [("k", 2, None, "b"), ("l", 1, "c", "d")]


# -- reports ---------------------------------------------------------------

def test_brands_are_grouped_by_id_and_name(spark):
    rows = spark.createDataFrame([(1, "a-b", 0.1), (1, "a-b", 0.2), (1, "", 5.0), (2, None, 1.0)],
                                 "tm_id bigint, tm_name string, final_detail_amount double")
    got = {(r.tm_id, r.tm_name): float(r.amount) for r in reports.brand_sums(rows).collect()}
    assert got == {(1, "a-b"): 0.3, (1, ""): 5.0, (2, None): 1.0}


def test_top_brands_interval_is_open(spark):
    rows = spark.createDataFrame([("2021-01-01", "1", 5.0), ("2021-01-02", "1", 1.0), ("2021-01-02", "2", 1.0),
                                  ("2021-01-02", "3", 2.0), ("2021-01-03", "3", 9.0)],
                                 "stat_time string, trademark_id string, amount double").selectExpr(
        "cast(stat_time as timestamp) stat_time", "trademark_id", "'n' trademark_name", "amount")
    top = reports.top_brands(rows, "2021-01-01", "2021-01-03", 2)
    assert [(r.trademark_id, float(r.amount)) for r in top.collect()] == [("3", 2.0), ("1", 1.0)]
    assert [tuple(r) for r in reports.chart(top).select("x", "s").collect()] == [("n", 1), ("n", 1)]


def wide_rows(spark):
    return spark.createDataFrame([
        ("2024-01-15", "2024-01-15 09:10:00", 1.5), ("2024-01-15", "2024-01-15 09:50:00", 2.0),
        ("2024-01-14", "2024-01-14 23:00:00", 4.0),
    ], "dt string, create_time string, final_detail_amount double")


def test_amounts_of_a_day(spark):
    wide = wide_rows(spark)
    assert float(reports.amount_total(wide, "2024-01-15").first().amount) == 3.5
    assert float(reports.amount_total(wide, "2030-01-01").first().amount) == 0
    hours = reports.amount_by_hour(wide)
    assert {(r.dt, r.hr): float(r.amount) for r in hours.collect()} == {("2024-01-15", "09"): 3.5, ("2024-01-14", "23"): 4.0}
    maps = {r.dt: {k: float(v) for k, v in r.hours.items()} for r in reports.hour_map(hours, "amount").collect()}
    assert maps == {"2024-01-15": {"09": 3.5}, "2024-01-14": {"23": 4.0}}
    both = {r.hr: (float(r.today), float(r.yesterday)) for r in reports.hour_compare(spark, hours, "amount", "2024-01-15").collect()}
    assert len(both) == 24 and both["09"] == (3.5, 0.0) and both["23"] == (0.0, 4.0) and both["00"] == (0.0, 0.0)


def test_shares_add_up(spark):
    rows = spark.createDataFrame([("x",)] * 3 + [("y",)], "g string")
    assert {r.grp: (r.n, r.pct) for r in reports.share(rows, "g").collect()} == {"x": (3, 75.0), "y": (1, 25.0)}


def test_detail_pages(spark):
    rows = spark.createDataFrame([(i, "Red Ring" if i % 2 else "string", "d1" if i < 8 else "d2") for i in range(12)],
                                 "order_detail_id int, sku_name string, dt string")
    page = reports.detail_page(rows, "ring", 2, 3)
    assert [(r.order_detail_id, r.total) for r in page.collect()] == [(7, 6), (9, 6), (11, 6)]
    assert [r.order_detail_id for r in reports.detail_page(rows, "RING", 1, 3, after_id=5).collect()] == [7, 9, 11]
    assert [r.order_detail_id for r in reports.detail_page(rows, "", 1, 2, day="d2").collect()] == [8, 9]


def test_document_search(spark):
    docs = spark.createDataFrame([
        (1, "red red ball", [(1, "a"), (3, "b")]), (2, "a Red, box", [(3, "b")]), (3, "redder", [(3, "b")]),
        (4, "red", [(4, "c")]), (5, "red", None),
    ], "id int, name string, actors array<struct<id:int,name:string>>")
    got = tables.search_documents(docs, "red", "name", "actors", "id", 3, "id")
    assert [tuple(r) for r in got.collect()] == [(1, 2), (2, 1)]


@pytest.mark.parametrize("n", [0, 1])
def test_top_of_24_hours(spark, n):
    rows = spark.createDataFrame([("d", f"{h % 24:02}") for h in range(30 * n)], "dt string, hr string")
    got = devices.hourly_count(rows, "d").collect()
    assert len(got) == 24 * n and [r.n for r in got] == [2] * 6 * n + [1] * 18 * n
