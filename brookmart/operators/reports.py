"""Sums and rankings over the wide table.

Amounts are added as whole cents, so a sum does not depend on row order. Every
aggregate combines on the map side; ties in a ranking go to the smaller id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from brookmart.functions.clock import pad_hour, previous_day
from brookmart.functions.money import cents, from_cents
from brookmart.functions.text import words

# Ids and names of the three headline figures.
TOTALS = (("dau", "新增日活"), ("new_mid", "新增设备"), ("order_amount", "新增交易额"))


def _amount(col: str = "final_detail_amount") -> Column:
    """Sum in cents, 0 over no rows or only nulls."""
    return F.coalesce(F.sum(cents(F.col(col))), F.lit(0).cast("bigint"))


def _with_amount(grouped: DataFrame) -> DataFrame:
    return grouped.withColumn("amount", from_cents(F.col("amount")))


# -- brands ----------------------------------------------------------------

def brand_sums(wide: DataFrame) -> DataFrame:
    """``(tm_id, tm_name, amount)``, grouped by both columns."""
    return _with_amount(wide.groupBy("tm_id", "tm_name").agg(_amount().alias("amount")))


def top_brands(stats: DataFrame, after: str, before: str, n: int) -> DataFrame:
    """The ``n`` brands with the greatest amount at times strictly between the two."""
    t = F.col("stat_time")
    sums = (
        stats.where((t > F.lit(after).cast("timestamp")) & (t < F.lit(before).cast("timestamp")))
        .groupBy("trademark_id", "trademark_name").agg(_amount("amount").alias("amount"))
    )
    return _with_amount(sums.orderBy(F.desc("amount"), "trademark_id").limit(n))


def chart(ranked: DataFrame) -> DataFrame:
    """Bars of a chart: name, height, series."""
    return ranked.select(F.col("trademark_name").alias("x"), F.col("amount").alias("y"),
                         F.lit(1).alias("s"))


# -- amounts by time -------------------------------------------------------

def amount_total(wide: DataFrame, day: str | None = None) -> DataFrame:
    """Amount per day; for one day exactly one row, 0 if nothing was sold."""
    if day:
        wide = wide.where(F.col("dt") == day)
        return _with_amount(wide.agg(_amount().alias("amount"))).select(F.lit(day).alias("dt"), "amount")
    return _with_amount(wide.groupBy("dt").agg(_amount().alias("amount")))


def amount_by_hour(wide: DataFrame, day: str | None = None) -> DataFrame:
    """Amount per hour, with the hour as two digits."""
    if day:
        wide = wide.where(F.col("dt") == day)
    hr = pad_hour(F.hour(F.to_timestamp("create_time")))
    return _with_amount(wide.groupBy("dt", hr.alias("hr")).agg(_amount().alias("amount")))


def hours_of_sales(sales: DataFrame) -> DataFrame:
    """Amount per hour from sums per day, hour and brand."""
    return _with_amount(sales.groupBy("dt", "hr").agg(_amount("amount").alias("amount")))


def hour_map(hours: DataFrame, value: str) -> DataFrame:
    """One row per day with ``{hour: value}``, at most 24 entries each."""
    entry = F.struct("hr", F.col(value))
    return hours.groupBy("dt").agg(F.map_from_entries(F.collect_list(entry)).alias("hours"))


def hour_compare(spark: SparkSession, hours: DataFrame, value: str, day: str) -> DataFrame:
    """All 24 hours with today's and yesterday's value, 0 where there is none."""
    yesterday = previous_day(day)
    two = hours.where((F.col("dt") == day) | (F.col("dt") == yesterday))
    zero = F.lit(0)
    sides = two.groupBy("hr").agg(
        F.sum(F.when(F.col("dt") == day, F.col(value))).alias("today"),
        F.sum(F.when(F.col("dt") != day, F.col(value))).alias("yesterday"))
    spine = spark.range(24).select(pad_hour(F.col("id")).alias("hr"))
    return spine.join(sides, "hr", "left").select(
        "hr", F.coalesce("today", zero).alias("today"), F.coalesce("yesterday", zero).alias("yesterday"))


def totals(seen: DataFrame, newcomers: DataFrame, wide: DataFrame, day: str) -> DataFrame:
    """The three headline figures of a day, ``(id, name, value)``, from the rows seen first
    on each day, new devices per day, and paid lines."""
    return headlines(seen.groupBy("dt").agg(F.count(F.lit(1)).alias("n")), newcomers, wide, day)


def headlines(active: DataFrame, newcomers: DataFrame, wide: DataFrame, day: str) -> DataFrame:
    """The same from active devices per day."""
    def one(which: int, rows: DataFrame, value: Column) -> DataFrame:
        key, name = TOTALS[which]
        return rows.where(F.col("dt") == day).agg(
            F.coalesce(value, F.lit(0)).cast("double").alias("value")
        ).select(F.lit(key).alias("id"), F.lit(name).alias("name"), "value")

    return (
        one(0, active, F.sum("n"))
        .unionByName(one(1, newcomers, F.sum("n")))
        .unionByName(one(2, wide, from_cents(F.sum(cents(F.col("final_detail_amount"))))))
    )


# -- buyers and products ---------------------------------------------------

def share(rows: DataFrame, by: str) -> DataFrame:
    """Rows per group and their part of all rows in percent. The total is taken
    over the few finished groups, not over the rows."""
    groups = rows.groupBy(F.col(by).alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    everything = F.sum("n").over(Window.partitionBy())
    return groups.withColumn(
        "pct", F.col("n").cast("double") * 100 / everything.cast("double"))


def province_sales(wide: DataFrame) -> DataFrame:
    return _with_amount(wide.groupBy("province_name").agg(_amount().alias("amount")))


def sku_sales(wide: DataFrame) -> DataFrame:
    return wide.groupBy("sku_name").agg(F.sum("sku_num").alias("num"))


def detail_page(wide: DataFrame, keyword: str, page: int, size: int, day: str | None = None,
                after_id: int | None = None) -> DataFrame:
    """One page of the order lines of a day that have the word in their product
    name, with the ``total`` number of them; no keyword finds all.

    Pages count from 1. Reading page p keeps p * size rows per task; for far
    pages pass the last id seen as ``after_id`` and page 1 instead.
    """
    found = wide
    if day:
        found = found.where(F.col("dt") == day)
    if keyword:
        found = found.where(F.array_contains(words(F.col("sku_name")), keyword.lower()))
    total = found.agg(F.count(F.lit(1))).scalar()
    if after_id is not None:
        found = found.where(F.col("order_detail_id") > after_id)
    return (
        found.orderBy("order_detail_id").offset((page - 1) * size).limit(size)
        .withColumn("total", total)
    )
