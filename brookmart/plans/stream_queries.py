"""The registered streaming queries.

Each replays a whole test table as a stream in four chunks, drains it through
the sink, restarting from the checkpoint for every chunk, and returns the sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from brookmart.functions.clock import DATE_TIME
from brookmart.operators import reports, routing
from brookmart.operators.firstorder import mark_first_orders
from brookmart.operators.lookups import with_province
from brookmart.operators.orderwide import order_wide
from brookmart.plans import warehouse
from brookmart.plans.queries import query
from brookmart.plans.replay import CHUNKS, Replay, Span, by_time, span
from brookmart.session import work_dir
from brookmart.sinks import bitmaps, buckets, ledger, rollup
from brookmart.sources import changes, shop
from brookmart.streaming import jobs
from brookmart.streaming.layers import DIMENSIONS, Layers
from brookmart.streaming.run import Handler, drain

def _replay(spark: SparkSession, source: Replay, handler: Handler,
            shape: Callable[[DataFrame], DataFrame] = lambda rows: rows, mode: str = "append",
            chunks: range = range(CHUNKS), checkpoint: str | None = None, times: int = 1) -> str:
    checkpoint = checkpoint or work_dir(spark, "checkpoint")
    for i in chunks:
        source.feed(i, times)
        drain(shape(source.stream()), handler, checkpoint, mode)
    return checkpoint


# -- scans -----------------------------------------------------------------

def _event_span(spark: SparkSession, folder: str) -> Span:
    return span(shop.events(spark, folder), F.col("ts"))


def _order_span(spark: SparkSession, folder: str) -> Span:
    return span(shop.orders(spark, folder), F.col("ts"))


def _events(spark: SparkSession, folder: str) -> Replay:
    rows = shop.events(spark, folder).select("event_id", "ts", "user_id")
    return Replay(spark, by_time(rows, F.col("ts"), _event_span(spark, folder)), "events")


@query
def stream_scan(spark, folder):
    source = _events(spark, folder)
    out = work_dir(spark, "scan")
    _replay(spark, source, jobs.append_to(out))
    return ledger.read(spark, out, source.schema).select(
        "event_id", F.unix_millis("ts").alias("ts"), "user_id")


@query
def stream_resume(spark, folder):
    """Stops after two chunks; a second run on the same checkpoint takes the rest."""
    source = _events(spark, folder)
    out = work_dir(spark, "resume")
    checkpoint = _replay(spark, source, jobs.append_to(out), chunks=range(2))
    _replay(spark, source, jobs.append_to(out), chunks=range(2, CHUNKS), checkpoint=checkpoint)
    return ledger.read(spark, out, source.schema).select("event_id")


# -- devices ---------------------------------------------------------------

@query
def stream_dau(spark, folder):
    logs = routing.route_logs(shop.log_lines(spark, folder))
    starts = logs.where(F.col("topic") == routing.START_TOPIC).drop("topic")
    at = F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint"))
    source = Replay(spark, by_time(starts, at, _event_span(spark, folder)), "logs")
    out = work_dir(spark, "dau")
    shape = jobs.first_seen_stream
    _replay(spark, source, jobs.append_to(out, by=("dt",)), shape, "update")
    now = ledger.read_latest(spark, out, shape(source.stream()).schema, ["dt", "mid"])
    return now.select("dt", "mid", "uid", F.col("offset").alias("event_id"))


def _device_days(spark: SparkSession, folder: str) -> str:
    """Bitmaps of devices by day, added batch by batch; the third batch fails after it
    was added and runs again."""
    rows = warehouse.start_records(spark, folder).select("dt", F.col("mid").alias("member"), F.timestamp_millis("ts").alias("at"))
    source = Replay(spark, by_time(rows, F.col("at"), _event_span(spark, folder)), "starts")
    out, checkpoint, failed = work_dir(spark, "device_days"), work_dir(spark, "checkpoint"), []

    def handler(batch, batch_id):
        bitmaps.add(batch, out, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise Failure("between the bitmaps and the commit")

    for i in range(CHUNKS):
        source.feed(i)
        _until_done(lambda: drain(source.stream(), handler, checkpoint))
    return out


@query
def bitmap_devices(spark, folder):
    """Active and new devices of every day."""
    return bitmaps.by_day(spark, _device_days(spark, folder))


@query
def bitmap_devices_day(spark, folder):
    """The same of one day, from its month's earlier days and the earlier months."""
    return bitmaps.of_day(spark, _device_days(spark, folder), shop.DAY)


@query
def sliding_window_count(spark, folder):
    source = _events(spark, folder)
    out = work_dir(spark, "windows")

    def shape(rows):
        return jobs.sliding_count(rows, "ts", "50 minutes", "5 minutes")

    _replay(spark, source, jobs.append_to(out), shape, "update")
    now = ledger.read_latest(spark, out, shape(source.stream()).schema, ["window_start"])
    return now.select(F.date_format("window_start", DATE_TIME).alias("window_start"), "n")


# -- order and line streams ------------------------------------------------

#: All orders are replayed within this time, so that chunks are minutes long and
#: lines come in a later chunk than their order.
REPLAY_SECONDS = 2400


def _pair_sources(spark: SparkSession, folder: str, again: tuple[int, ...] = (0,)) -> tuple[Replay, Replay]:
    """Orders by creation time, and lines up to 89 seconds later; both sent so many
    seconds after the first time."""
    lo, hi = _order_span(spark, folder)
    start = F.lit(shop.DAY).cast("timestamp")
    place = F.call_function("div", (F.unix_seconds("ts") - F.lit(lo)) * REPLAY_SECONDS, F.lit(hi - lo + 1))
    orders = shop.orders(spark, folder).select(
        F.col("id").alias("order_id"), (start + F.make_dt_interval(secs=place)).alias("order_ts"))
    lines = shop.order_details(spark, folder, shop.large_orders(spark, folder)).select(F.col("id").alias("order_detail_id"), "order_id")
    delay = F.make_dt_interval(secs=F.pmod("order_detail_id", F.lit(90)))
    lines = lines.join(orders, "order_id").select(
        "order_detail_id", "order_id", (F.col("order_ts") + delay).alias("detail_ts"))
    first = spark.sql("select unix_seconds(timestamp'%s 00:00:00')" % shop.DAY).first()[0]
    within = (first, first + REPLAY_SECONDS + max(again) - 1)

    def source(rows: DataFrame, at: str, name: str) -> Replay:
        later = F.explode(F.array(*[F.make_dt_interval(secs=F.lit(s)) for s in again]))
        rows = rows.withColumn("_later", later).withColumn(at, F.col(at) + F.col("_later")).drop("_later")
        return Replay(spark, by_time(rows, F.col(at), within), name)

    return source(orders, "order_ts", "orders"), source(lines, "detail_ts", "lines")


def _pairs(spark: SparkSession, sources: tuple[Replay, Replay], times: int,
           shape: Callable[[DataFrame, DataFrame], DataFrame],
           sink: Callable[[str], Handler] = jobs.append_to) -> DataFrame:
    orders, lines = sources
    out, checkpoint = work_dir(spark, "pairs"), work_dir(spark, "checkpoint")
    handler = sink(out)
    for i in range(CHUNKS):
        orders.feed(i, times)
        lines.feed(i, times)
        drain(shape(orders.stream(), lines.stream()).select("order_id", "order_detail_id", "detail_ts"),
              handler, checkpoint)
    schema = shape(orders.stream(), lines.stream()).select("order_id", "order_detail_id").schema
    return ledger.read(spark, out, schema).select(
        "order_id", F.col("order_detail_id").alias("detail_id"))


@query
def stream_interval_join(spark, folder):
    """A line may come in a later chunk than its order, which the join's state keeps."""
    return _pairs(spark, _pair_sources(spark, folder), 1, jobs.interval_join)


@query
def stream_pair_dedup(spark, folder):
    """Orders and lines are sent again 6 and 12 minutes later, and every chunk twice.
    The third time comes more than 10 minutes after the first, and in another chunk;
    it is known by the second, which renewed the pair's time."""
    def shape(orders, lines):
        return jobs.interval_join(jobs.distinct_stream(orders, ["order_id", "order_ts"], "order_ts"),
                                  jobs.distinct_stream(lines, ["order_detail_id", "detail_ts"], "detail_ts"),
                                  late=None)

    seen = work_dir(spark, "seen")
    return _pairs(spark, _pair_sources(spark, folder, (0, 360, 720)), 2, shape, lambda out: jobs.distinct_handler(
        seen, ["order_id", "order_detail_id"], "detail_ts", jobs.append_to(out)))


@query
def stream_split_payment(spark, folder):
    """Line n of every order arrives in minute n, from the fourth on together."""
    orders, large = shop.orders(spark, folder).drop("ts"), shop.large_orders(spark, folder)
    lines = shop.order_details(spark, folder, large)
    if large is None:
        lines = shop.with_order_sum(lines)
    else:
        orders = shop.with_original_amount(orders, spark, folder)
    wide = order_wide(orders, lines, large).select(
        "order_id", "order_detail_id", "detail_amount", "original_total_amount", "final_total_amount")
    number = F.call_function("div", "order_detail_id", F.lit(shop.DETAIL_STEP)).cast("int")
    chunk = F.least(number, F.lit(CHUNKS - 1))
    arrives = F.lit(shop.DAY).cast("timestamp") + F.make_dt_interval(mins=chunk)
    source = Replay(spark, wide.withColumns({"ts": arrives, "_chunk": chunk}), "wide")
    sums, out = work_dir(spark, "sums"), work_dir(spark, "paid")
    _replay(spark, source, jobs.split_payment_handler(sums, out))
    return spark.read.parquet(out).select(
        "order_id", F.col("order_detail_id").alias("detail_id"), "final_cents")


def _order_replay(spark: SparkSession, folder: str) -> Replay:
    rows = shop.with_province_id(shop.orders(spark, folder), spark, folder)
    return Replay(spark, by_time(rows, F.col("ts"), _order_span(spark, folder)), "orders")


@query
def stream_first_order(spark, folder):
    source = _order_replay(spark, folder)
    status, out = work_dir(spark, "status"), work_dir(spark, "marked")
    _replay(spark, source, jobs.first_order_handler(status, out))
    return spark.read.parquet(out).select("id", "if_first_order")


@query
def stream_dim_refresh(spark, folder):
    """The second half of the provinces arrives before the third chunk."""
    source = _order_replay(spark, folder)
    provinces = shop.provinces(spark, folder)
    table, out = work_dir(spark, "provinces"), work_dir(spark, "refreshed")
    late = F.col("id").cast("int") > 12
    buckets.upsert(provinces.where(~late), table, 0, ["id"])

    def handler(batch, batch_id):
        now = buckets.lookup(batch, ["province_id"], table, provinces.schema, ["id"])
        ledger.write_batch(with_province(batch, now), out, batch_id)

    checkpoint = _replay(spark, source, handler, chunks=range(2))
    buckets.upsert(provinces.where(late), table, 1, ["id"])
    _replay(spark, source, handler, chunks=range(2, CHUNKS), checkpoint=checkpoint)
    return spark.read.parquet(out).select("id", "province_name")


# -- sinks -----------------------------------------------------------------

class Failure(RuntimeError):
    """Raised on purpose, once at each place."""


def _until_done(drained: Callable[[], None]) -> int:
    """Start again from the checkpoint after each failure; how many there were."""
    failures = 0
    while True:
        try:
            drained()
            return failures
        except StreamingQueryException as e:
            if Failure.__name__ not in str(e):
                raise
            failures += 1


@query
def sink_exactly_once(spark, folder):
    """Brand sums per batch; the handler fails in the third batch after its write, and
    the query is started again on its checkpoint."""
    wide = warehouse.wide(spark, folder, people=False).select(
        F.to_timestamp("create_time").alias("ts"), "tm_id", "tm_name", "final_detail_amount")
    source = Replay(spark, by_time(wide, F.col("ts"), _order_span(spark, folder)), "brands")
    out, checkpoint = work_dir(spark, "stats"), work_dir(spark, "checkpoint")
    store, failed = jobs.brand_sum_handler(out), []

    def handler(batch, batch_id):
        store(batch, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise Failure("between the write and the commit")

    for i in range(CHUNKS):
        source.feed(i)
        _until_done(lambda: drain(source.stream(), handler, checkpoint))
    if not failed:
        raise AssertionError("there was no third batch to fail")
    stats = spark.read.parquet(out)
    return reports.brand_sums(stats.withColumnRenamed("amount", "final_detail_amount")).withColumn(
        "amount", F.col("amount").cast("double"))


def _sales(spark: SparkSession, folder: str) -> str:
    """Sums per day, hour and brand of all lines, added batch by batch; the third batch
    fails after it was added and runs again."""
    wide = warehouse.wide(spark, folder, people=False).select(
        F.to_timestamp("create_time").alias("ts"), "dt", "create_time", "tm_id", "tm_name", "final_detail_amount")
    source = Replay(spark, by_time(wide, F.col("ts"), _order_span(spark, folder)), "sales")
    out, checkpoint, failed = work_dir(spark, "sales"), work_dir(spark, "checkpoint"), []

    def handler(batch, batch_id):
        rollup.add(batch, out, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise Failure("between the sums and the commit")

    for i in range(CHUNKS):
        source.feed(i)
        _until_done(lambda: drain(source.stream(), handler, checkpoint))
    return out


@query
def rollup_amount_hour(spark, folder):
    hours = reports.hours_of_sales(rollup.read(spark, _sales(spark, folder)))
    return hours.withColumn("amount", F.col("amount").cast("double"))


@query
def rollup_trademark_topn(spark, folder):
    """The ranking over an interval, from the buckets of its days."""
    between = "2023-12-31", "2024-01-16"
    sales = rollup.read(spark, _sales(spark, folder), rollup.days_between(*between))
    stats = sales.select(F.col("dt").cast("timestamp").alias("stat_time"), F.col("tm_id").cast("string").alias("trademark_id"),
                         F.col("tm_name").alias("trademark_name"), "amount")
    return reports.top_brands(stats, *between, 5).withColumn("amount", F.col("amount").cast("double"))


def _stat_sums(layers: Layers) -> DataFrame:
    sums = reports.brand_sums(layers.stats().select(
        F.col("trademark_id").cast("bigint").alias("tm_id"),
        F.col("trademark_name").alias("tm_name"), F.col("amount").alias("final_detail_amount")))
    return sums.withColumn("amount", F.col("amount").cast("double"))


@query
def layers_brand_sum(spark, folder):
    """All jobs from change messages to brand sums, in two spans of time."""
    return _stat_sums(build_layers(spark, folder))


class FailingLayers(Layers):
    """Fails in the second batch of every job that publishes: once between the files
    and their manifest, and once between the manifest and the checkpoint."""

    def __init__(self, *args, **named):
        super().__init__(*args, **named)
        self.failed = set()

    def step(self, name: str, job: str, batch_id: int) -> None:
        if batch_id == 1 and (name, job) not in self.failed:
            self.failed.add((name, job))
            raise Failure(f"{job}: {name}")


@query
def layers_replay(spark, folder):
    """As ``layers_brand_sum``, with jobs that fail and start again on their checkpoints."""
    layers = build_layers(spark, folder, kind=FailingLayers)
    want = {(name, job) for name in ("written", "published") for job in ("changes", "orders", "details", "wide")}
    if layers.failed != want:
        raise AssertionError(f"failed in {layers.failed} only")
    return _stat_sums(layers)


def build_layers(spark: SparkSession, folder: str, chunks: int = 2, kind: type[Layers] = Layers) -> Layers:
    """The tables of the running jobs, fed with the whole shop."""
    layers = kind(spark, work_dir(spark, "layers"), as_of=shop.AS_OF)
    dims, facts = changes.shop_rows(spark, folder)
    # chunk 0 holds the dimensions, the facts follow by time
    facts = by_time(facts, F.col("ts"), _order_span(spark, folder), chunks)
    rows = dims.withColumn("_chunk", F.lit(0)).unionByName(
        facts.select("value", (F.col("_chunk") + 1).alias("_chunk")))
    rows = rows.withColumn("offset", F.lit(0).cast("bigint"))
    source = Replay(spark, rows, "changes")
    for i in range(chunks + 1):
        source.feed(i)
        _until_done(lambda: layers.route_changes(source.stream(), drain=True).awaitTermination())
        if i == 0:
            for name in DIMENSIONS:
                layers.load_dimension(name, drain=True).awaitTermination()
            continue
        for job in (layers.enrich_orders, layers.enrich_details, layers.join_wide, layers.sum_brands):
            _until_done(lambda: job(drain=True).awaitTermination())
    return layers


@query
def fan_out(spark, folder):
    source = _order_replay(spark, folder)
    status, orders, topic = (work_dir(spark, n) for n in ("status", "orders", "topic"))
    write = jobs.fan_out_handler(status, orders, topic, "dwd_order_info")

    def handler(batch, batch_id):
        known = buckets.lookup(batch, ["user_id"], status, jobs.STATUS, ["user_id"], before=batch_id)
        write(mark_first_orders(batch, known), batch_id)

    _replay(spark, source, handler)
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("sink"), "n")
        for name, rows in (
            ("user_status", buckets.read(spark, status, jobs.STATUS, ["user_id"])),
            ("order_info", spark.read.parquet(orders)),
            ("dwd_order_info", spark.read.parquet(topic)),
        )
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
