"""Answers of the report interface, over the tables of the running jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from brookmart.operators import devices, reports
from brookmart.streaming.layers import Layers


def realtime_total(layers: Layers, date: str) -> DataFrame:
    """Active devices, new devices and amount of a day: ``(id, name, value)``."""
    counts = layers.device_counts(date)
    paid = layers.sales(date).withColumnRenamed("amount", "final_detail_amount")
    newcomers = counts.select("dt", F.col("n_new").alias("n"))
    return reports.headlines(counts, newcomers, paid, date)


def realtime_hour(layers: Layers, id: str, date: str) -> DataFrame | None:
    """Today's and yesterday's curve over 24 hours; None for an unknown figure."""
    if id == "dau":
        return reports.hour_compare(layers.spark, devices.hourly_count(layers.devices()), "n", date)
    if id == "order_amount":
        before = str(dt.date.fromisoformat(date) - dt.timedelta(days=1))
        hours = reports.hours_of_sales(layers.sales(date, before))
        return reports.hour_compare(layers.spark, hours, "amount", date)
    return None


def trademark_sum(layers: Layers, start_date: str, end_date: str, top_n: int) -> DataFrame:
    """Bars of the best-selling brands between two times."""
    return reports.chart(reports.top_brands(layers.stats(), start_date, end_date, top_n))


def sale_detail(layers: Layers, date: str | None, keyword: str, page: int, size: int) -> DataFrame:
    return reports.detail_page(layers.wide(date), keyword, page, size)


def buyer_share(layers: Layers, by: str) -> DataFrame:
    """``by`` is ``user_age_group`` or ``user_gender``."""
    return reports.share(layers.wide(), by)
