"""Shop tables derived from the star-schema test tables.

Every function takes (spark, folder) and reads ``<folder>/<table>.parquet``.
All of it is projections, aggregates and joins over whole tables, so its work
grows with them. The SQL twins of these views are in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from brookmart.functions.clock import DATE_TIME
from brookmart.functions.people import with_profile
from brookmart.operators.hot import HOT_ROWS, hot_keys, running_sums, with_part
from brookmart.operators.lookups import denormalize_sku
from brookmart.schemas import MONEY

# Fixed values of the mapping.
SHIFT_DAYS = 8217          # moves the order history so that it ends with the logs, 2024-01-30
DETAIL_STEP = 1 << 40      # line number n of order o gets id (n - 1) * DETAIL_STEP + o
AS_OF = "2024-01-01"       # day at which ages are taken
DAY = "2024-01-15"         # a day inside the logs and the orders
DAY_BEFORE = "2024-01-14"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a proper timestamp; the files hold one without time zone."""
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """App logs as messages ``(offset, value)``; views and clicks are app starts."""
    e = events(spark, folder)
    user = F.col("user_id").cast("string")
    start = F.when(F.col("event_type").isin("view", "click"), F.struct(
        F.lit("icon").alias("entry"), F.get_json_object("props", "$.k").cast("bigint").alias("loading_time")))
    body = F.struct(
        F.struct(F.lit("web").alias("ch"), F.concat(F.lit("mid_"), user).alias("mid"),
                 user.alias("uid"), F.lit("v2.1").alias("vc")).alias("common"),
        start.alias("start"),
        F.unix_millis("ts").alias("ts"),
    )
    return e.select(F.col("event_id").alias("offset"), F.to_json(body).alias("value"))


def stored_date(day: str) -> Column:
    """The date under which the orders of a day are stored."""
    return F.expr(f"cast(date'{day}' - {SHIFT_DAYS} as timestamp_ntz)")


def orders(spark: SparkSession, folder: str, days: tuple[str, ...] = (),
           between: tuple[str, str] | None = None) -> DataFrame:
    """Order rows without province and original amount, of all days, of the given
    ones, or of those strictly ``between`` two; the days reach the scan as a filter."""
    o = table(spark, folder, "orders")
    if days:
        o = o.where(F.col("o_orderdate").isin(*map(stored_date, days)))
    if between:
        o = o.where((F.col("o_orderdate") > stored_date(between[0])) & (F.col("o_orderdate") < stored_date(between[1])))
    created = (F.col("o_orderdate").cast("timestamp")
               + F.make_dt_interval(F.lit(SHIFT_DAYS), F.lit(0), F.lit(0),
                                    F.col("o_orderkey") * 37 % 86400))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("final_total_amount"),
        F.date_format(created, DATE_TIME).alias("create_time"),
        F.date_format(created, "yyyy-MM-dd").alias("create_date"),
        created.alias("ts"),
    )


def with_province_id(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("province_id"))
    return rows.join(c, "user_id", "left")


def with_original_amount(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """The original amount of an order is the sum of its lines."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("original_total_amount"))
    return rows.join(lines, "id", "left")


def with_order_sum(lines: DataFrame) -> DataFrame:
    """The same amount on each of the lines, taken over the partitions in which they
    are numbered; for lines without very large orders."""
    whole = F.sum("detail_amount").over(Window.partitionBy("order_id"))
    return lines.withColumn("original_total_amount", whole.cast(MONEY))


# lines of an order are numbered in this order, in which those of a very large
# order are cut into parts
LINE_ORDER = ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]


def large_orders(spark: SparkSession, folder: str, more_than: int = HOT_ROWS) -> DataFrame | None:
    hot = hot_keys(table(spark, folder, "lineitem"), "l_orderkey", more_than)
    return hot and hot.withColumnRenamed("l_orderkey", "order_id")


def order_details(spark: SparkSession, folder: str, large: DataFrame | None = None,
                  of: DataFrame | None = None) -> DataFrame:
    """Order lines with an id, of all orders or of the ids in ``of``. Lines of the
    ``large`` orders are numbered part by part; parts follow the numbering, so they
    also serve to spread later sums."""
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), *LINE_ORDER, "l_quantity")
    if of is not None:
        rows = rows.join(of.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    if large is not None:
        rows = with_part(rows, "order_id", LINE_ORDER, large)
    numbered = running_sums(rows, "order_id", LINE_ORDER, {"_n": F.lit(1).cast("bigint")}, large is not None)
    return numbered.select(
        ((F.col("_n") - 1) * F.lit(DETAIL_STEP) + F.col("order_id")).alias("id"),
        "order_id",
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("l_extendedprice").cast(MONEY).alias("detail_amount"),
        *([] if large is None else ["_part"]),
    )


def text_id(name: Column) -> Column:
    """A number made from a name, as text: dimension ids are text."""
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10)


def users(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    raw = c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
    )
    return with_profile(raw, AS_OF)


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_nationkey").cast("string")
    return table(spark, folder, "nation").select(
        n.alias("id"), F.col("n_name").alias("name"), n.alias("area_code"),
        F.concat(F.lit("N-"), n).alias("iso_code"))


def raw_skus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        text_id(F.col("p_name")).alias("spu_id"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_name").alias("sku_name"),
        text_id(F.col("p_brand")).alias("tm_id"),
        text_id(F.col("p_type")).alias("category3_id"),
    )


def _names(spark: SparkSession, folder: str, column: str, key: str, name: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col(column).alias(name)).distinct().select(
        text_id(F.col(name)).alias(key), name)


def trademarks(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder, "p_brand", "tm_id", "tm_name")


def categories(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder, "p_type", "id", "name")


def spus(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder, "p_name", "id", "spu_name")


def skus(spark: SparkSession, folder: str) -> DataFrame:
    return denormalize_sku(raw_skus(spark, folder), trademarks(spark, folder),
                           categories(spark, folder), spus(spark, folder))


def stored_skus(spark: SparkSession, folder: str) -> DataFrame:
    """The SKU dimension as it is stored: with the names ``skus`` looks up. Read
    without joins, its size is known when a query is planned."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        text_id(F.col("p_name")).alias("spu_id"), F.col("p_name").alias("spu_name"),
        F.col("p_name").alias("sku_name"),
        text_id(F.col("p_brand")).alias("tm_id"), F.col("p_brand").alias("tm_name"),
        text_id(F.col("p_type")).alias("category3_id"), F.col("p_type").alias("category3_name"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with an array of label objects. The array is a set of at most
    four different objects, so a document with very many labels stays small."""
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(
        F.collect_set(F.struct("quality", "toxic")).alias("labels"))
    return table(spark, folder, "documents").join(labels, "doc_id", "left")
