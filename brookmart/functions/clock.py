"""Dates and hours. All text keys are in the session time zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed formats of the stored keys.
DAY = "yyyy-MM-dd"
HOUR = "HH"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def millis_to_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def day_key(ts: Column) -> Column:
    return F.date_format(ts, DAY)


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, HOUR)


def pad_hour(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def previous_day(day: str | Column) -> Column:
    return F.date_format(F.date_sub(F.to_date(F.lit(day) if isinstance(day, str) else day), 1), DAY)


def with_log_time(logs: DataFrame, ms: str = "ts") -> DataFrame:
    """Add ``dt`` and ``hr`` from epoch milliseconds."""
    at = millis_to_time(F.col(ms))
    return logs.withColumns({"dt": day_key(at), "hr": hour_key(at)})


def with_order_time(orders: DataFrame) -> DataFrame:
    """Split ``create_time`` text into ``create_date`` and ``create_hour``."""
    part = F.split("create_time", " ")
    return orders.withColumns({
        "create_date": F.get(part, F.lit(0)),
        "create_hour": F.get(F.split(F.get(part, F.lit(1)), ":"), F.lit(0)),
    })
