"""Splitting of hot keys.

A window or join on a key sends all rows of one key to one task. When a key
holds more than ``HOT_ROWS`` rows, its rows are range-sorted by key and order and
cut where Spark's sample of them says, so that parts are of about equal size
however the order values lie; rows of one order value may be in several parts. All
other keys keep the single part ``COLD``. Data is looked at first: where no key
is hot, as is usual, plans are built without parts.

Rows of hot keys are written once with their part, so that all that follows sees
the same parts; other rows are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brookmart.session import work_dir

HOT_ROWS = 1_000_000
COLD = -1
#: Groups of keys that are counted before any key is, at least, and for as many rows
#: as a key may have.
GROUPS, GROUPS_EACH = 4096, 16


def hot_keys(rows: DataFrame, key: str, more_than: int = HOT_ROWS) -> DataFrame | None:
    """Keys with too many rows, ``(key, _parts)``, or None if there are none.

    Runs an aggregate over the column now, unless there are too few rows for any key
    to be hot. Groups of keys by hash are counted first, which shuffles a row per group
    and task; a hot key's group has at least its rows, so only the keys of groups with
    too many are counted by themselves. What it finds is written to the work folder, so
    that it is counted once and Spark knows its size.
    """
    n = rows.count()
    if n <= more_than:
        return None
    group = F.pmod(F.xxhash64(key), F.lit(max(GROUPS, GROUPS_EACH * n // max(more_than, 1))))
    counts = rows.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    # no more than one of GROUPS_EACH
    large = [r._group for r in counts.where(F.col("_n") > more_than).collect()]
    if not large:
        return None
    found = (
        rows.where(group.isin(large)).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)
        .select(key, F.ceil(F.col("_n") / more_than).cast("int").alias("_parts"))
    )
    if found.isEmpty():
        return None
    path = work_dir(rows.sparkSession, "hot")
    found.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def with_part(rows: DataFrame, key: str, order: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_part``, by which rows of a hot key are spread: it never falls as the
    ``order`` values rise, nulls first."""
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, "parts")
    n = hot.agg(F.sum("_parts")).first()[0]
    # a number per row, so that equal rows can be parted too
    ranged = rows.join(hot, key, "left_semi").withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        n, key, *order, "_row")
    ranged.drop("_row").withColumn("_part", F.spark_partition_id()).write.parquet(path)
    schema = rows.withColumn("_part", F.lit(COLD)).schema
    cold = rows.join(hot, key, "left_anti").withColumn("_part", F.lit(COLD))
    return cold.unionByName(spark.read.schema(schema).parquet(path))


def parts_of(parted: DataFrame, key: str) -> DataFrame:
    """``(key, _part)`` of the hot keys among rows that ``with_part`` has parted."""
    return parted.where(F.col("_part") != COLD).select(key, "_part").distinct()


def per_part(rows: DataFrame, key: str, parts: DataFrame) -> DataFrame:
    """Repeat the rows of a hot key once per part, for a join on ``(key, _part)``."""
    return rows.join(parts, key, "left").withColumn("_part", F.coalesce("_part", F.lit(COLD)))


def running_sums(rows: DataFrame, key: str, order: list[str], sums: dict[str, Column],
                 parted: bool = False) -> DataFrame:
    """Add sums over the rows of the same key up to and including the row.

    ``parted`` rows carry ``_part``: each part is summed by itself, and the total of
    the parts before it is added, from a row for each key and part.
    """
    by = [key, "_part"] if parted else [key]
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    if not parted:
        return out
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.where(F.col("_part") != COLD)
        .groupBy(key, "_part").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
        .select(key, "_part", *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in sums])
    )
    return (
        out.join(totals, [key, "_part"], "left")
        .withColumns({n: F.col(n) + F.coalesce(F.col(f"_b_{n}"), F.lit(0)) for n in sums})
        .drop(*[f"_b_{n}" for n in sums])
    )
