"""The warehouse layers put together over the shop tables, in batch."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brookmart.functions.clock import with_order_time
from brookmart.operators import devices, lookups, routing
from brookmart.operators.hot import HOT_ROWS
from brookmart.operators.orderwide import order_wide, split_payment
from brookmart.schemas import MONEY
from brookmart.sources import shop


def start_records(spark: SparkSession, folder: str) -> DataFrame:
    """Flat device records of all start logs."""
    routed = routing.route_logs(shop.log_lines(spark, folder))
    starts = routed.where(F.col("topic") == routing.START_TOPIC)
    return devices.flatten(devices.parse_logs(starts))


def first_seen(spark: SparkSession, folder: str) -> DataFrame:
    return devices.first_seen(start_records(spark, folder))


class Days(NamedTuple):
    """Which orders to read: of all days, of some, or of those strictly between two."""

    days: tuple[str, ...] = ()
    between: tuple[str, str] | None = None

    def orders(self, spark: SparkSession, folder: str) -> DataFrame:
        return shop.orders(spark, folder, self.days, self.between)


ALL = Days()


def orders(spark: SparkSession, folder: str, when: Days = ALL) -> DataFrame:
    """Orders with province and user, without the first-order mark."""
    rows = shop.with_province_id(when.orders(spark, folder), spark, folder)
    rows = lookups.with_province(with_order_time(rows), shop.provinces(spark, folder))
    return lookups.with_user(rows, shop.users(spark, folder))


def details(spark: SparkSession, folder: str, large: DataFrame | None = None,
            of: DataFrame | None = None) -> DataFrame:
    """Order lines with brand, category and product line."""
    return lookups.with_sku(shop.order_details(spark, folder, large, of), shop.stored_skus(spark, folder),
                            sku_name=F.col("sku_name"))


def joined(spark: SparkSession, folder: str, large: DataFrame | None = None,
           when: Days = ALL, people: bool = True, products: bool = True) -> DataFrame:
    """Order lines with their order. ``people`` looks up province and user,
    ``products`` brand, category and product line; a report asks for what it
    needs, as Spark cannot drop a left join on its own.

    Lines are read once: an order's original amount, the sum of its lines, is taken
    where they are joined, over the same partitions. Where an order has too many for
    one task, its sum is an aggregate of its own. Of some days' orders, no other
    lines are shuffled.
    """
    left = orders(spark, folder, when) if people else with_order_time(when.orders(spark, folder))
    of = None if when == ALL else when.orders(spark, folder)
    lines = (details if products else shop.order_details)(spark, folder, large, of)
    if large is not None:
        return order_wide(shop.with_original_amount(left, spark, folder), lines, large)
    whole = F.sum("detail_amount").over(Window.partitionBy("order_id"))
    return order_wide(left, lines).withColumn("original_total_amount", whole.cast(MONEY))


def wide(spark: SparkSession, folder: str, when: Days = ALL, people: bool = True,
         products: bool = True, more_than: int = HOT_ROWS) -> DataFrame:
    """The same with the payment spread over the lines."""
    large = shop.large_orders(spark, folder, more_than)
    return split_payment(joined(spark, folder, large, when, people, products), large)


def paid_lines(spark: SparkSession, folder: str, *days: str) -> DataFrame:
    """As ``wide`` without any lookups, of all days or the given ones."""
    return wide(spark, folder, Days(days), people=False, products=False)
