"""Device activity from start logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brookmart.functions.clock import with_log_time
from brookmart.operators.keyed import first_per_key
from brookmart.schemas import DAU_INFO, LOG


def parse_logs(logs: DataFrame) -> DataFrame:
    """``(offset, common, ts, dt, hr)`` of each log message."""
    parsed = logs.select("offset", F.from_json("value", LOG).alias("log"))
    return with_log_time(parsed.select("offset", "log.common", "log.ts"))


def flatten(parsed: DataFrame) -> DataFrame:
    """The flat device record; the minute is always ``00``."""
    made = {"mi": F.lit("00"), "dt": F.col("dt"), "hr": F.col("hr"), "ts": F.col("ts")}
    return parsed.select("offset", *[
        made.get(name, F.col(f"common.{name}")).alias(name) for name in DAU_INFO.names])


def first_seen(devices: DataFrame) -> DataFrame:
    """The earliest record of each device and day, by time and then offset."""
    return first_per_key(devices, ["dt", "mid"], ["ts", "offset"])


def daily_count(seen: DataFrame, day: str | None = None) -> DataFrame:
    """Active devices per day, from first-seen rows."""
    if day:
        seen = seen.where(F.col("dt") == day)
    return seen.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def hourly_count(seen: DataFrame, day: str | None = None) -> DataFrame:
    """First-seen devices per hour; for one day the 24 largest hours."""
    if day:
        seen = seen.where(F.col("dt") == day)
    hours = seen.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))
    return hours.orderBy(F.desc("n"), "hr").limit(24) if day else hours


def new_devices(devices: DataFrame) -> DataFrame:
    """Devices per first-ever day."""
    firsts = devices.groupBy("mid").agg(F.min("dt").alias("dt"))
    return firsts.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
