"""The registered batch queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brookmart.functions.clock import with_log_time, with_order_time
from brookmart.functions.jsonrows import field, parse_typed
from brookmart.functions.money import cents
from brookmart.operators import devices, reports, routing
from brookmart.operators.firstorder import mark_first_orders, user_status
from brookmart.operators.lookups import with_province, with_sku, with_user
from brookmart.plans import warehouse
from brookmart.schemas import ORDER_INFO, USER_INFO
from brookmart.session import tune, work_dir
from brookmart.sinks import ledger, ordered, postings, topics
from brookmart.sources import changes, shop, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(tune(spark), folder)

    QUERIES[f.__name__] = run
    return run


def _double(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast("double") for n in names})


# -- sources ---------------------------------------------------------------

@query
def dim_scan(spark, folder):
    return tables.query(spark, "select id, user_level, birthday, gender from {users}",
                        users=shop.users(spark, folder))


@query
def key_list_lookup(spark, folder):
    users = shop.users(spark, folder)
    found = tables.by_keys(users, "id", shop.orders(spark, folder), "user_id")
    return found.select("id", "user_level")


@query
def doc_get(spark, folder):
    docs = shop.table(spark, folder, "documents")
    return tables.get_document(docs, "doc_id", 7).select("doc_id", "lang", "n_chars")


@query
def doc_search(spark, folder):
    return tables.search_documents(shop.documents(spark, folder), word="the", text="text",
                                   objects="labels", field="quality", value=1, key="doc_id")


@query
def doc_search_ranked(spark, folder):
    """The best documents for two words by a stored index. A first batch holds drafts of
    the English documents, a second all documents as they are now."""
    path = work_dir(spark, "index")
    docs = shop.table(spark, folder, "documents").select("doc_id", "text")
    drafts = shop.table(spark, folder, "documents").where("lang = 'en'").select(
        "doc_id", F.concat_ws(" ", F.lit("draft the"), "text", "source").alias("text"))
    postings.add(drafts, path, 0, "doc_id", "text")
    postings.add(docs, path, 1, "doc_id", "text")
    return postings.search(spark, path, ["The", "query"]).withColumnRenamed("doc", "doc_id")


# -- messages --------------------------------------------------------------

@query
def route_logs(spark, folder):
    routed = routing.route_logs(shop.log_lines(spark, folder))
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _per_topic(routed: DataFrame) -> DataFrame:
    return routed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum(field(F.col("value"), "id", "bigint")).alias("id_sum"))


@query
def cdc_route_canal(spark, folder):
    return _per_topic(routing.route_canal(changes.canal(spark, folder)))


@query
def cdc_route_maxwell(spark, folder):
    return _per_topic(routing.route_maxwell(changes.maxwell(spark, folder)))


@query
def cdc_apply_ordered(spark, folder):
    """Histories of all users in two batches that mix all steps; what is left of them."""
    path, messages = work_dir(spark, "users"), changes.versions(spark, folder)
    for batch in range(2):
        routed = routing.with_commit(routing.route_maxwell(messages.where(F.col("batch") == batch)))
        ordered.apply(ordered.parse(routed, USER_INFO), path, batch, USER_INFO, ["id"])
    return ordered.read(spark, path, USER_INFO, ["id"]).select("id", "user_level")


@query
def json_parse_dynamic(spark, folder):
    return shop.table(spark, folder, "events").select(
        "event_id", field(F.col("props"), "k", "bigint").alias("k"))


@query
def json_parse_typed(spark, folder):
    orders = shop.orders(spark, folder).drop("ts")
    messages = topics.to_messages(orders, "ods_order_info")
    parsed = parse_typed(messages, ORDER_INFO)
    return _double(parsed.select("id", "user_id", F.col("final_total_amount").alias("amount"),
                                 "feight_fee"), "amount", "feight_fee")


@query
def log_time_parts(spark, folder):
    rows = shop.events(spark, folder).select("event_id", F.unix_millis("ts").alias("ts"))
    return with_log_time(rows).select("event_id", "dt", "hr")


@query
def order_time_parts(spark, folder):
    rows = shop.orders(spark, folder).drop("create_date")
    return with_order_time(rows).select("id", "create_date", "create_hour")


# -- devices ---------------------------------------------------------------

@query
def dau_flatten(spark, folder):
    return warehouse.start_records(spark, folder).select("mid", "uid", "dt", "hr", "mi", "ts")


@query
def dau_first_seen(spark, folder):
    return warehouse.first_seen(spark, folder).select("dt", "mid", F.col("offset").alias("event_id"))


@query
def dau_total(spark, folder):
    return devices.daily_count(warehouse.first_seen(spark, folder))


@query
def dau_hour(spark, folder):
    return devices.hourly_count(warehouse.first_seen(spark, folder))


@query
def dau_total_day(spark, folder):
    return devices.daily_count(warehouse.first_seen(spark, folder), shop.DAY)


@query
def dau_hour_day(spark, folder):
    return devices.hourly_count(warehouse.first_seen(spark, folder), shop.DAY)


@query
def hour_compare_dau(spark, folder):
    hours = devices.hourly_count(warehouse.first_seen(spark, folder))
    return reports.hour_compare(spark, hours, "n", shop.DAY)


@query
def new_devices(spark, folder):
    return devices.new_devices(warehouse.start_records(spark, folder))


# -- dimensions and lookups ------------------------------------------------

@query
def user_profile(spark, folder):
    return shop.users(spark, folder).select("id", "age_group", "gender_name")


@query
def sku_denormalize(spark, folder):
    return shop.skus(spark, folder).select(
        F.col("id").alias("sku_id"), "tm_name", "category3_name", "spu_name")


@query
def join_province_broadcast(spark, folder):
    orders = shop.with_province_id(shop.orders(spark, folder), spark, folder)
    return with_province(orders, shop.provinces(spark, folder)).select(
        "id", "province_name", "province_area_code")


@query
def join_user(spark, folder):
    return with_user(shop.orders(spark, folder), shop.users(spark, folder)).select(
        "id", "user_age_group", "user_gender")


@query
def join_sku(spark, folder):
    lines = shop.order_details(spark, folder, shop.large_orders(spark, folder))
    rows = with_sku(lines, shop.skus(spark, folder))
    return rows.select(F.col("id").alias("detail_id"), "sku_id", "tm_id", "tm_name",
                       "category3_name", "spu_name")


@query
def first_order_mark(spark, folder):
    return mark_first_orders(shop.orders(spark, folder)).select("id", "user_id", "if_first_order")


@query
def user_status_update(spark, folder):
    return user_status(mark_first_orders(shop.orders(spark, folder)))


# -- wide table ------------------------------------------------------------

@query
def order_wide(spark, folder):
    wide = warehouse.joined(spark, folder, shop.large_orders(spark, folder))
    return wide.select("order_id", F.col("order_detail_id").alias("detail_id"), "dt", "user_id",
                       "sku_id", cents(F.col("detail_amount")).alias("amount_cents"), "tm_name",
                       "province_name", "user_age_group")


@query
def split_payment(spark, folder):
    return warehouse.paid_lines(spark, folder).select(
        "order_id", F.col("order_detail_id").alias("detail_id"), "final_cents")


# -- reports ---------------------------------------------------------------

@query
def trademark_batch_sum(spark, folder):
    return _double(reports.brand_sums(warehouse.wide(spark, folder, people=False)), "amount")


def _brand_stats(spark: SparkSession, folder: str, after: str, before: str) -> DataFrame:
    """Brand sums of every day between two, as a daily batch would store them."""
    wide = warehouse.wide(spark, folder, warehouse.Days(between=(after, before)), people=False)
    return wide.groupBy("dt", "tm_id", "tm_name").agg(
        F.sum("final_detail_amount").alias("amount")
    ).select(F.col("dt").cast("timestamp").alias("stat_time"),
             F.col("tm_id").cast("string").alias("trademark_id"),
             F.col("tm_name").alias("trademark_name"), "amount")


def _top(spark: SparkSession, folder: str) -> DataFrame:
    between = "2018-01-01", "2024-01-01"
    return reports.top_brands(_brand_stats(spark, folder, *between), *between, 5)


@query
def trademark_topn(spark, folder):
    return _double(_top(spark, folder), "amount")


@query
def trademark_chart(spark, folder):
    return _double(reports.chart(_top(spark, folder)), "y")


@query
def order_amount_total(spark, folder):
    return _double(reports.amount_total(warehouse.paid_lines(spark, folder)), "amount")


@query
def order_amount_hour(spark, folder):
    return _double(reports.amount_by_hour(warehouse.paid_lines(spark, folder)), "amount")


@query
def order_amount_day(spark, folder):
    return _double(reports.amount_total(warehouse.paid_lines(spark, folder, shop.DAY), shop.DAY), "amount")


@query
def order_hour_map(spark, folder):
    """The day's map of hours, shown as rows."""
    hours = reports.amount_by_hour(warehouse.paid_lines(spark, folder, shop.DAY), shop.DAY)
    by_day = reports.hour_map(hours, "amount")
    return _double(by_day.select("dt", F.explode("hours").alias("hr", "amount")), "amount")


@query
def hour_compare_amount(spark, folder):
    hours = reports.amount_by_hour(warehouse.paid_lines(spark, folder, shop.DAY, shop.DAY_BEFORE))
    return _double(reports.hour_compare(spark, hours, "amount", shop.DAY), "today", "yesterday")


@query
def realtime_total(spark, folder):
    return reports.totals(
        warehouse.first_seen(spark, folder),
        devices.new_devices(warehouse.start_records(spark, folder)),
        warehouse.paid_lines(spark, folder, shop.DAY), shop.DAY)


@query
def buyer_age_share(spark, folder):
    return reports.share(warehouse.joined(spark, folder, products=False), "user_age_group")


@query
def buyer_gender_share(spark, folder):
    return reports.share(warehouse.joined(spark, folder, products=False), "user_gender")


@query
def province_sales(spark, folder):
    return _double(reports.province_sales(warehouse.wide(spark, folder, products=False)), "amount")


@query
def sku_sales(spark, folder):
    return reports.sku_sales(warehouse.joined(spark, folder, people=False))


@query
def sale_detail_page(spark, folder):
    rows = warehouse.joined(spark, folder, shop.large_orders(spark, folder))
    page = reports.detail_page(rows, "ring", page=2, size=20)
    return page.select(F.col("order_detail_id").alias("detail_id"), "order_id", "sku_name", "dt",
                       "user_gender", "total")


# -- sinks -----------------------------------------------------------------

@query
def sink_topic_json(spark, folder):
    wide = warehouse.wide(spark, folder, people=False).select(
        "order_detail_id", "order_id", "dt", "sku_id", "sku_num", "tm_name", "final_detail_amount")
    path = work_dir(spark, "topic")
    ledger.write_batch(topics.to_messages(wide, "dws_order_wide"), path, 0)
    return spark.read.parquet(path).select("topic", "value")


@query
def sink_upsert(spark, folder):
    """All users, then a second batch of those with a debt at a new level."""
    c = shop.table(spark, folder, "customer")
    key = F.col("c_custkey").cast("string")
    columns = ("id", "name", "version")  # the table's, by position
    first = c.select(key, "c_name", F.lit(1)).toDF(*columns)
    second = c.where("c_acctbal < 0").select(
        key, F.concat("c_name", F.lit("*")), F.lit(2)).toDF(*columns)
    path = work_dir(spark, "users")
    ledger.upsert(first, path, 0, ["id"])
    ledger.upsert(second, path, 1, ["id"])
    return ledger.read_latest(spark, path, first.schema, ["id"])


@query
def sink_append(spark, folder):
    """Wide rows in two batches, read back per day."""
    wide = warehouse.paid_lines(spark, folder).select(
        F.substring("dt", 1, 7).alias("month"), "dt", "order_id", "order_detail_id",
        "order_status", "final_cents")
    path = work_dir(spark, "wide")
    ledger.write_batch(wide.where("order_status = 'F'"), path, 0, by=("month",))
    ledger.write_batch(wide.where("order_status <> 'F'"), path, 1, by=("month",))
    return ledger.read(spark, path, wide.schema).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), (F.sum("final_cents").cast("double") / 100).alias("amount"))


@query
def sink_upsert_daily(spark, folder):
    """The day's devices written twice under their id."""
    seen = warehouse.first_seen(spark, folder)
    path = work_dir(spark, "dau")
    ledger.write_batch(seen, path, 0, by=("dt",))
    ledger.write_batch(seen, path, 1, by=("dt",))
    now = ledger.read_latest(spark, path, seen.schema, ["dt", "mid"])
    return now.groupBy("dt", "mid").agg(F.count(F.lit(1)).alias("n"))


@query
def raw_log_archive(spark, folder):
    lines = with_log_time(shop.log_lines(spark, folder).withColumn(
        "ts", field(F.col("value"), "ts", "bigint")))
    path = work_dir(spark, "archive")
    topics.archive_text(lines, path)
    return spark.read.text(path).groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def batch_sample(spark, folder):
    return topics.sample(shop.table(spark, folder, "events").select("event_id"), "event_id")


@query
def batch_count(spark, folder):
    return shop.table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("n"))
