import time

import pytest
from pyspark.sql import functions as F

from brookmart.operators import routing
from brookmart.plans import serve, stream_queries
from brookmart.plans.replay import Replay
from brookmart.session import work_dir
from brookmart.sinks import buckets, ledger, manifest, outbox, topics
from brookmart.sources import streams
from brookmart.streaming import jobs
from brookmart.streaming.run import drain, offsets


class Feed:
    """A folder that a stream follows, fed from lists."""

    def __init__(self, spark, schema):
        self.spark, self.path = spark, work_dir(spark, "feed")
        self.empty = spark.createDataFrame([], schema)
        self.empty.write.parquet(self.path)

    def add(self, *rows):
        made = self.spark.createDataFrame(list(rows), self.empty.schema)
        made.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return streams.file_stream(self.spark, self.path, self.empty.schema)


def at(text):
    return F.lit(text).cast("timestamp")


def test_chunks_are_moved_not_written_again(spark):
    rows = spark.createDataFrame([(i, i % 2) for i in range(20)], "id bigint, _chunk int")
    source = Replay(spark, rows, "moved")
    staged = manifest.files(spark, f"{source.stage}/_chunk=0")
    source.feed(0)
    assert sorted(n for _, n in manifest.files(spark, source.path) if n in {m for _, m in staged}) == sorted(n for _, n in staged)
    assert not manifest.files(spark, f"{source.stage}/_chunk=0")
    source.feed(1, times=2)
    got = sorted(r.id for r in spark.read.schema(source.schema).parquet(source.path).collect())
    assert got == sorted([*range(0, 20, 2), *range(1, 20, 2), *range(1, 20, 2)])


# -- dedup and joins -------------------------------------------------------

def test_copies_within_the_time_are_dropped(spark):
    """A pair sent again after 9 minutes is dropped. When the newest event seen
    is more than 10 minutes past its end of life, it is forgotten."""
    feed = Feed(spark, "order_id int, order_detail_id int, ts string")
    out, checkpoint = work_dir(spark, "out"), work_dir(spark, "ck")

    def run():
        rows = feed.stream().withColumn("ts", F.to_timestamp("ts"))
        drain(jobs.distinct_stream(rows, ["order_id", "order_detail_id"], "ts"), jobs.append_to(out), checkpoint)

    for pair, ts in ((1, "12:00:00"), (1, "12:09:00"), (2, "12:25:00"), (1, "12:30:00")):
        feed.add((pair, 1, f"2024-01-01 {ts}"), (pair, 1, f"2024-01-01 {ts}"))
        run()
    got = sorted(str(r.ts)[11:] for r in spark.read.parquet(out).where("order_id = 1").collect())
    assert got == ["12:00:00", "12:30:00"]


@pytest.mark.parametrize("salts", [1, 3])
def test_interval_join_bounds(spark, salts):
    orders = Feed(spark, "order_id int, order_ts string")
    lines = Feed(spark, "order_id int, order_detail_id int, detail_ts string")
    out = work_dir(spark, "out")
    orders.add((1, "2024-01-01 12:00:00"), (2, "2024-01-01 12:00:00"))
    lines.add((1, 10, "2024-01-01 12:00:50"), (1, 11, "2024-01-01 12:00:51"), (1, 12, "2024-01-01 11:59:10"),
              (1, 13, "2024-01-01 11:59:09"), (3, 14, "2024-01-01 12:00:00"))
    pairs = jobs.interval_join(orders.stream().withColumn("order_ts", F.to_timestamp("order_ts")),
                               lines.stream().withColumn("detail_ts", F.to_timestamp("detail_ts")), salts=salts)
    drain(pairs, jobs.append_to(out), work_dir(spark, "ck"))
    assert sorted(r.order_detail_id for r in spark.read.parquet(out).collect()) == [10, 12]


def test_late_logs_do_not_count_again(spark):
    """A log more than a day behind the newest is dropped."""
    feed = Feed(spark, "offset bigint, value string")
    out, checkpoint = work_dir(spark, "out"), work_dir(spark, "ck")

    def log(offset, ms):
        return offset, f'{{"common":{{"mid":"a"}},"start":{{}},"ts":{ms}}}'

    day = 86_400_000
    for batch in ([log(1, 10 * day + 5)], [log(2, 10 * day + 1), log(3, 13 * day)], [log(4, 10 * day)]):
        feed.add(*batch)
        drain(jobs.first_seen_stream(feed.stream()), jobs.append_to(out), checkpoint, "update")
    schema = jobs.first_seen_stream(feed.stream()).schema
    now = ledger.read_latest(spark, out, schema, ["dt", "mid"])
    assert {(r.dt, r.offset) for r in now.collect()} == {("1970-01-11", 2), ("1970-01-14", 3)}


def test_state_in_rocksdb_gives_the_same(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        test_late_logs_do_not_count_again(spark)
    finally:
        spark.conf.set(name, before)


# -- exactly once ----------------------------------------------------------

class Crash(Exception):
    pass


def failing_after_write(handler, at_batch):
    seen = []

    def handle(batch, batch_id):
        handler(batch, batch_id)
        seen.append(batch_id)
        if batch_id == at_batch and seen.count(at_batch) == 1:
            raise Crash("between the write and the commit")

    return handle, seen


def run_with_crash(feed, shape, handler, batches, crash_at):
    checkpoint = work_dir(feed.spark, "ck")
    handle, seen = failing_after_write(handler, crash_at)
    for rows in batches:
        feed.add(*rows)
        while True:
            try:
                drain(shape(feed.stream()), handle, checkpoint)
                break
            except Exception as e:
                assert "between the write and the commit" in str(e)
    assert seen.count(crash_at) == 2


def test_brand_sums_survive_a_crash(spark):
    feed = Feed(spark, "tm_id bigint, tm_name string, final_detail_amount double")
    out = work_dir(spark, "out")
    run_with_crash(feed, lambda rows: rows, jobs.brand_sum_handler(out, "2024-01-01"),
                   [[(1, "a", 1.0), (1, "a", 2.0)], [(1, "a", 4.0), (2, "b", 8.0)], [(2, "b", 16.0)]], 1)
    got = spark.read.parquet(out).groupBy("tm_id").agg(F.sum("amount").alias("a")).collect()
    assert {r.tm_id: float(r.a) for r in got} == {1: 7.0, 2: 24.0}


def test_first_orders_survive_a_crash(spark):
    """The flags of a batch that runs again come out the same."""
    feed = Feed(spark, "id bigint, user_id bigint, create_time string")
    status, out = work_dir(spark, "status"), work_dir(spark, "out")
    run_with_crash(feed, lambda rows: rows, jobs.first_order_handler(status, out),
                   [[(1, 7, "t1"), (2, 7, "t1")], [(3, 8, "t2"), (4, 7, "t2")], [(5, 8, "t3"), (6, 9, "t3")]], 1)
    marks = {r.id: r.if_first_order for r in spark.read.parquet(out).collect()}
    assert marks == {1: "1", 2: "0", 3: "1", 4: "0", 5: "0", 6: "1"}
    assert sorted(r.user_id for r in buckets.read(spark, status, jobs.STATUS, ["user_id"]).collect()) == ["7", "8", "9"]


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_payment_over_batches_survives_a_crash(spark, hot_rows):
    feed = Feed(spark, "order_id bigint, order_detail_id bigint, detail_amount double, "
                       "original_total_amount double, final_total_amount double, at string")
    sums, out = work_dir(spark, "sums"), work_dir(spark, "out")

    def line(order, n, minute):
        return order, order * 10 + n, 1.0, 3.0, 1.0, f"2024-01-01 12:{minute:02}:00"

    batches = [
        [line(1, 1, 0), line(2, 1, 0), line(3, 1, 0), line(3, 2, 0), line(3, 3, 0)],
        [line(1, 2, 5)],
        [line(1, 3, 14), line(2, 2, 11), line(2, 3, 11)],   # order 2 was forgotten after 10 minutes
    ]
    shape = lambda rows: rows.withColumn("ts", F.to_timestamp("at")).drop("at")
    run_with_crash(feed, shape, jobs.split_payment_handler(sums, out, hot_rows=hot_rows), batches, 1)
    got = {r.order_detail_id: r.final_cents for r in spark.read.parquet(out).collect()}
    assert got == {11: 33, 12: 33, 13: 34, 31: 33, 32: 33, 33: 34, 21: 33, 22: 33, 23: 33}


def test_one_line_dated_ahead_forgets_no_order(spark):
    feed = Feed(spark, "order_id bigint, order_detail_id bigint, detail_amount double, "
                       "original_total_amount double, final_total_amount double, at string")
    sums, out = work_dir(spark, "sums"), work_dir(spark, "out")
    batches = [
        [(1, 11, 1.0, 3.0, 1.0, "2024-01-01 12:00:00"), (5, 51, 1.0, 3.0, 1.0, "2024-01-01 12:00:00"),
         (9, 91, 1.0, 1.0, 1.0, "2024-01-01 12:45:00")],
        [(1, 12, 1.0, 3.0, 1.0, "2024-01-01 12:01:00"), (5, 52, 3.0, 3.0, 1.0, "2024-01-01 12:01:00")],
        [(1, 13, 1.0, 3.0, 1.0, "2024-01-01 12:02:00"), (5, 53, -1.0, 3.0, 1.0, "2024-01-01 12:02:00")],
    ]
    shape = lambda rows: rows.withColumn("ts", F.to_timestamp("at")).drop("at")
    run_with_crash(feed, shape, jobs.split_payment_handler(sums, out), batches, 1)
    got = {r.order_detail_id: r.final_cents for r in spark.read.parquet(out).collect()}
    assert (got[11], got[12], got[13]) == (33, 33, 34)
    # the last running sum of order 5 is smaller than the one before it
    assert {r.order_id: r.amount_before for r in buckets.read(spark, sums, jobs.SUMS, ["order_id"]).collect()}[5] == 300


def test_copies_keep_their_types(spark):
    rows = spark.createDataFrame(
        [(1, None), (1, 2**53 + 1), (2, 2**53 + 1), (2, None)], "k bigint, v bigint").coalesce(1)
    got = sorted(map(tuple, jobs.combine_copies(rows, ["k"]).collect()))
    assert got == [(1, None), (2, 2**53 + 1)]
    assert jobs.combine_copies(rows, ["v"]).count() == 2


def test_a_repeated_order_is_first_once(spark):
    feed = Feed(spark, "id bigint, user_id bigint, create_time string")
    status, out = work_dir(spark, "status"), work_dir(spark, "out")
    run_with_crash(feed, lambda rows: rows, jobs.first_order_handler(status, out),
                   [[(1, 7, "t1"), (1, 7, "t1"), (2, 7, "t0")], [(3, 8, "t2")], [(3, 8, "t2")]], 1)
    marks = sorted((r.id, r.if_first_order) for r in spark.read.parquet(out).collect())
    assert marks == [(1, "0"), (2, "1"), (3, "0"), (3, "1")]


def test_resume_and_offsets(spark):
    feed = Feed(spark, "id int")
    out, checkpoint = work_dir(spark, "out"), work_dir(spark, "ck")
    for i in range(3):
        feed.add((i,))
        query = drain(feed.stream(), jobs.append_to(out), checkpoint)
        assert offsets(query)[0]["numInputRows"] == 1
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2]


# -- ledger ----------------------------------------------------------------

@pytest.mark.parametrize("every", [2, 3, 100])
def test_ledger_upsert_delete_and_full_batches(spark, every):
    """The merged table is the same whether and where it was written in full."""
    path = work_dir(spark, "t")
    schema = "id string, v int, kind string"
    batches = [[("a", 1, "insert"), ("b", 1, "insert")], [("a", 2, "update"), ("a", 3, "update"), ("b", 0, "delete")],
               [("c", 5, "insert")], [], [("a", 9, "update")]]
    rows = spark.createDataFrame([], schema)
    assert ledger.read_latest(spark, path, rows.schema, ["id"]).count() == 0

    def now(**kw):
        return sorted((r.id, r.v) for r in ledger.read_latest(spark, path, rows.schema, ["id"], ["v"], **kw).collect())

    def write(i):
        ledger.upsert(spark.createDataFrame(batches[i], schema), path, i, ["id"], ["v"], every)

    for i in range(5):
        write(i)
        write(i)  # each batch runs twice
    assert now() == [("a", 9), ("b", 0), ("c", 5)]
    assert now(drop_deletes="kind") == [("a", 9), ("c", 5)]
    for before, want in ((1, [("a", 1), ("b", 1)]), (2, [("a", 3), ("b", 0)]), (4, [("a", 3), ("b", 0), ("c", 5)])):
        assert now(before=before) == want
    newest = ledger.read_changes(spark, path, rows.schema)
    assert newest.count() == {2: 4, 3: 4, 100: 7}[every]


def test_ledger_expire_keeps_what_is_read(spark):
    path = work_dir(spark, "t")
    schema = "id string, v int"
    for i in range(7):
        ledger.upsert(spark.createDataFrame([(f"k{i % 3}", i)], schema), path, i, ["id"], full_every=2)
    rows = spark.createDataFrame([], schema)
    before = sorted(map(tuple, ledger.read_latest(spark, path, rows.schema, ["id"]).collect()))
    assert before == [("k0", 6), ("k1", 4), ("k2", 5)]
    # full at 1, 3 and 5: batches 0 to 3 and the first full writing go
    assert ledger.expire(spark, path) == 5 and ledger.expire(spark, path) == 0
    assert sorted(map(tuple, ledger.read_latest(spark, path, rows.schema, ["id"]).collect())) == before


def test_ledger_skips_a_batch_that_is_not_finished(spark):
    path = work_dir(spark, "t")
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    ledger.upsert(rows, path, 0, ["id"])
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch_id=1")
    assert ledger.read_changes(spark, path, rows.schema).count() == 1


def test_a_committed_batch_is_read_without_success_markers(spark):
    path = work_dir(spark, "t")
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        ledger.write_batch(rows, path, 0)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert ledger.read_batch(spark, path, rows.schema, 0).count() == ledger.read(spark, path, rows.schema).count() == 1
    assert ledger.read_batch(spark, path, rows.schema, -1).count() == 0
    # a batch begun and not committed is not read, and asking for it raises
    rows.write.parquet(f"{path}/batch_id=1")
    assert ledger.read(spark, path, rows.schema).count() == 1
    with pytest.raises(LookupError):
        ledger.read_batch(spark, path, rows.schema, 1)


def test_many_batches_leave_few_folders(spark):
    path = work_dir(spark, "t")
    for i in range(13):
        ledger.upsert(spark.createDataFrame([(f"k{i % 3}", i)], "id string, v int"), path, i, ["id"], full_every=3, tidy=True)
    assert len(ledger._ids(spark, path, ledger.BATCH)) <= 6 and len(ledger._ids(spark, path, ledger.FULL)) == 2


def test_messages_leave_nulls_out(spark):
    rows = spark.createDataFrame([(1, None)], "id int, name string")
    assert tuple(topics.to_messages(rows, "t", "id").first()) == ("t", "1", '{"id":1}')


def test_canal_counts(spark):
    """As many messages as rows in the inserted arrays."""
    rows = spark.createDataFrame([(f'{{"type":"INSERT","table":"t","data":{[{"id": i} for i in range(n)]}}}'.replace("'", '"'),)
                                  for n in range(6)], "value string")
    assert routing.route_canal(rows).count() == sum(range(6))


# -- all layers ------------------------------------------------------------

@pytest.fixture(scope="module")
def layers(spark, sf):
    made = stream_queries.build_layers(spark, sf)
    logs = Feed(spark, "offset bigint, value string")
    hour = 3_600_000
    day = 1_705_276_800_000  # 2024-01-15
    logs.add(*[(i, f'{{"common":{{"mid":"m{m}"}},"start":{{}},"ts":{day + t}}}') for i, (m, t) in enumerate(
        [(1, hour), (1, 2 * hour), (2, 2 * hour), (1, -hour), (3, -2 * hour)])], (9, '{"common":{"mid":"m9"},"ts":%d}' % day))
    made.route_logs(logs.stream(), drain=True).awaitTermination()
    made.find_devices(drain=True).awaitTermination()
    return made


def test_layers_totals(layers):
    rows = {r.id: r.value for r in serve.realtime_total(layers, "2024-01-15").collect()}
    paid = layers.wide().where("dt = '2024-01-15'").agg(F.sum("final_detail_amount").alias("s")).first().s
    assert rows == {"dau": 2.0, "new_mid": 1.0, "order_amount": float(paid or 0)}


def test_layers_hours(layers):
    curve = {r.hr: (r.today, r.yesterday) for r in serve.realtime_hour(layers, "dau", "2024-01-15").collect()}
    assert len(curve) == 24
    assert {h: v for h, v in curve.items() if v != (0, 0)} == {"01": (1, 0), "02": (1, 0), "23": (0, 1), "22": (0, 1)}
    day = layers.wide().agg(F.max("dt")).first()[0]
    paid = layers.wide(day).agg(F.sum("final_detail_amount")).first()[0]
    amounts = serve.realtime_hour(layers, "order_amount", day).collect()
    assert len(amounts) == 24 and sum(r.today for r in amounts) == paid > 0
    assert serve.realtime_hour(layers, "other", "2024-01-15") is None


def test_layers_rows(layers):
    wide = layers.wide()
    assert wide.count() == 6000
    assert wide.where("tm_name is null or province_name is null or user_age_group is null").count() == 0
    off = wide.groupBy("order_id", "final_total_amount").agg(F.sum("final_detail_amount").alias("s")).where("s <> final_total_amount")
    assert off.count() == 0
    users = wide.where("if_first_order = '1'").select("order_id", "user_id").distinct()
    assert users.count() == users.select("user_id").distinct().count()


def test_layers_chart_page_and_share(layers):
    bars = serve.trademark_sum(layers, "2000-01-01", "2999-01-01", 3).collect()
    assert len(bars) == 3 and bars[0].y >= bars[1].y >= bars[2].y
    assert sum(r.pct for r in serve.buyer_share(layers, "user_gender").collect()) == pytest.approx(100)
    wide = layers.wide().withColumn("sku_name", F.col("spu_name"))
    assert wide.count() == 6000


def test_archive_by_day(layers):
    days = layers.spark.read.parquet(layers.path("log_archive")).groupBy("dt").count().collect()
    assert {str(r.dt): r["count"] for r in days} == {"2024-01-15": 4, "2024-01-14": 2}


def test_kafka_needs_its_connector(spark):
    """Without the connector the scan is refused, with the options it was given."""
    with pytest.raises(Exception, match="kafka"):
        streams.kafka_stream(spark, "host:9092", "t", {0: 5})


def test_handlers_of_stateful_streams_are_planned_adaptively(spark):
    feed = Feed(spark, "id int, at string")
    feed.add((1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"))
    seen = []

    def handler(batch, batch_id):
        grouped = batch.groupBy("id").count()
        seen.append((grouped.count(), "Adaptive" in grouped._jdf.queryExecution().executedPlan().toString()))

    rows = feed.stream().withColumn("at", F.to_timestamp("at"))
    drain(jobs.distinct_stream(rows, ["id"], "at"), handler, work_dir(spark, "ck"))
    assert seen[0] == (2, True)


def test_interval_trigger_runs(spark):
    from brookmart.streaming.run import start
    feed = Feed(spark, "id int")
    feed.add((1,))
    out = work_dir(spark, "out")
    query = start(feed.stream(), jobs.append_to(out), work_dir(spark, "ck"))
    try:
        limit = time.time() + 60
        while query.lastProgress is None and time.time() < limit:
            time.sleep(0.2)
    finally:
        query.stop()
    assert [r.id for r in spark.read.parquet(out).select("id").collect()] == [1]


def test_state_lies_in_as_many_parts_as_cores(spark, tmp_path):
    from brookmart.streaming import run

    rows = spark.range(20).select(F.col("id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("at"))
    rows.write.parquet(str(tmp_path / "in"))
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        stream = jobs.distinct_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), ["id"], "at")

        def handle(batch, batch_id):
            # a batch's own shuffles are as wide as the session says
            wide = batch.groupBy("id").count()
            seen.append((wide.count(), batch.sparkSession.conf.get(
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum")))

        query = run.drain(stream, handle, str(tmp_path / "checkpoint"))
        parts = {s["numShufflePartitions"] for p in query.recentProgress for s in p["stateOperators"]}
        assert parts == {run.state_parts(spark)} and parts.pop() <= max(8, spark.sparkContext.defaultParallelism)
        assert seen[0] == (20, "64")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("cores, parts", [(1, 8), (3, 9), (4, 8), (6, 12), (8, 8), (12, 12), (40, 40), (90, 64)])
def test_no_core_waits_for_the_last_parts_of_state(cores, parts):
    """Eight parts on six cores take as long as twelve."""
    from types import SimpleNamespace as Fake

    from brookmart.streaming import run

    settings = {"spark.sql.shuffle.partitions": "64"}
    assert run.state_parts(Fake(conf=settings, sparkContext=Fake(defaultParallelism=cores))) == parts


def test_pairs_in_state_of_a_cluster(spark):
    """With a cluster's settings the join gives the same; rows are not counted, for which
    every write would read first."""
    from brookmart.session import CLUSTER_SETTINGS

    orders = Feed(spark, "order_id int, order_ts string")
    lines = Feed(spark, "order_id int, order_detail_id int, detail_ts string")
    out, checkpoint = work_dir(spark, "out"), work_dir(spark, "ck")
    before, counted = {k: spark.conf.get(k, None) for k in CLUSTER_SETTINGS}, []
    try:
        for k, v in CLUSTER_SETTINGS.items():
            spark.conf.set(k, v)
        for o, d in (([(1, "12:00:00"), (2, "12:00:30")], [(1, 10, "12:00:20")]),
                     ([(3, "12:01:00")], [(1, 11, "12:00:50"), (2, 12, "12:01:21"), (2, 13, "12:01:20"), (3, 14, "12:00:10")])):
            orders.add(*[(i, f"2024-01-01 {at}") for i, at in o])
            lines.add(*[(i, n, f"2024-01-01 {at}") for i, n, at in d])
            pairs = jobs.interval_join(
                jobs.distinct_stream(orders.stream().withColumn("order_ts", F.to_timestamp("order_ts")), ["order_id"], "order_ts"),
                jobs.distinct_stream(lines.stream().withColumn("detail_ts", F.to_timestamp("detail_ts")), ["order_detail_id"], "detail_ts"),
                late=None)
            query = drain(pairs, jobs.append_to(out), checkpoint)
            counted += [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(r.order_detail_id for r in spark.read.parquet(out).collect()) == [10, 11, 13, 14]
    assert not any(counted)


def test_kept_rows_lie_in_few_parts(spark):
    """What a handler keeps is not in as many parts as its shuffles, and reads column by column."""
    feed = Feed(spark, "id int, n int, at string")
    feed.add(*[(i, i % 3, f"2024-01-01 00:00:{i % 60:02}") for i in range(500)], (1, 9, "2024-01-01 00:00:00"))
    before, seen, got = spark.conf.get("spark.sql.shuffle.partitions"), [], []
    spark.conf.set("spark.sql.shuffle.partitions", "64")

    def then(rows, batch_id):
        got.extend(rows.collect())
        seen.append((rows.rdd.getNumPartitions(), [f.dataType.typeName() for f in rows.schema]))

    try:
        drain(feed.stream().withColumn("at", F.to_timestamp("at")),
              jobs.distinct_handler(work_dir(spark, "seen"), ["id"], "at", then), work_dir(spark, "ck"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0][0] < 16 and seen[0][1] == ["integer", "integer", "timestamp"]
    assert sorted((r.id, r.n, r["at"].second) for r in got) == sorted(
        [(i, i % 3, i % 60) for i in range(500) if i != 1] + [(1, 9, 0)])
