"""First and last row per key, as aggregates with map-side combine.

A window with row_number would send every row of a key to one task; these send
one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], best) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    return rows.groupBy(*keys).agg(best(row).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(rows, keys, order, F.min)


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(rows, keys, order, F.max)
