"""Splitting of raw streams into topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brookmart.functions.jsonrows import field, has_object
from brookmart.schemas import MAXWELL

# Target topics, table names and row kinds.
START_TOPIC = "start_log"
EVENT_TOPIC = "event_log"
TOPIC_PREFIX = "ods_"
FACT_TABLES = ("order_info", "order_detail")
DIMENSION_TABLES = (
    "base_province", "user_info", "sku_info", "base_trademark", "base_category3", "spu_info",
)
CANAL_INSERT = "INSERT"
MAXWELL_INSERT = "insert"
MAXWELL_DELETE = "delete"
#: The place of a transaction's last row.
LAST_PLACE = (1 << 63) - 1


def route_logs(logs: DataFrame) -> DataFrame:
    """A log with a ``start`` object, even an empty one, is a start log."""
    return logs.withColumn(
        "topic",
        F.when(has_object(F.col("value"), "start"), START_TOPIC).otherwise(EVENT_TOPIC),
    )


def _envelope(changes: DataFrame, *more: str) -> DataFrame:
    """``(type, table, data)`` of each change, with ``data`` still as JSON text, and
    ``_name`` for every further field.

    ``json_tuple`` parses a message once; filters pushed below ``from_json``
    would parse it once more per condition.
    """
    return changes.select(*_others(changes), F.json_tuple("value", *MAXWELL.names, *more).alias(
        *MAXWELL.names, *[f"_{name}" for name in more]))


def _others(changes: DataFrame) -> list[str]:
    return [c for c in changes.columns if c != "value"]


def _target() -> Column:
    return F.concat(F.lit(TOPIC_PREFIX), F.col("table")).alias("topic")


def route_canal(changes: DataFrame) -> DataFrame:
    """One message per inserted row: ``(topic, value)`` and the change's other columns."""
    return (
        _envelope(changes).where(F.col("type") == CANAL_INSERT)
        .select(_target(), F.explode(F.from_json("data", "array<string>")).alias("value"),
                *_others(changes))
    )


def route_maxwell(changes: DataFrame) -> DataFrame:
    """Inserted fact rows and all changes of dimension rows: ``(topic, value,
    type, commit)`` and the change's other columns.

    A deleted dimension row passes as well; its ``commit`` says so, and when and where
    in which transaction the change was committed. The last row of a transaction bears
    the mark ``commit`` instead of a place.
    """
    facts = F.col("table").isin(*FACT_TABLES) & (F.col("type") == MAXWELL_INSERT)
    dims = F.col("table").isin(*DIMENSION_TABLES)
    last = F.when(F.col("_commit") == "true", F.lit(LAST_PLACE))
    commit = F.struct(
        F.col("_ts").try_cast("bigint").alias("_ts"), F.col("_xid").try_cast("bigint").alias("_xid"),
        F.coalesce(F.col("_xoffset").try_cast("bigint"), last).alias("_xoffset"),
        F.coalesce(F.col("type") == MAXWELL_DELETE, F.lit(False)).alias("_deleted"))
    return (
        _envelope(changes, "ts", "xid", "xoffset", "commit")
        .where(F.col("data").isNotNull() & (F.col("data") != "{}") & (facts | dims))
        .select(_target(), F.col("data").alias("value"), "type", commit.alias("commit"), *_others(changes))
    )


def with_commit(routed: DataFrame) -> DataFrame:
    """Messages of dimension topics with their ``commit`` in the row, as ``_commit``;
    whoever reads a row by its type does not see it. Rows without commits stay as they are."""
    if "commit" not in routed.columns:
        return routed
    dims = F.col("topic").isin(*[TOPIC_PREFIX + name for name in DIMENSION_TABLES])
    marked = F.concat(F.lit('{"_commit":'), F.to_json("commit"), F.lit(","), F.expr("substring(value, 2)"))
    return routed.withColumn("value", F.when(dims, marked).otherwise(F.col("value"))).drop("commit")


def row_key() -> Column:
    """The key of a routed row, by which a topic keeps changes of a row in order."""
    brands = F.col("topic") == TOPIC_PREFIX + "base_trademark"
    return F.when(brands, field(F.col("value"), "tm_id")).otherwise(field(F.col("value"), "id"))
