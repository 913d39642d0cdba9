"""Money as whole cents, so that sums are exact and independent of row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brookmart.schemas import MONEY


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def from_cents(amount: Column) -> Column:
    """Cents back to DECIMAL(18,2)."""
    return (amount.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def round_cents(amount: Column) -> Column:
    """Round half up (toward positive infinity on a tie) to two places.

    ``F.round`` takes ties away from zero, which differs for negative doubles.
    """
    return F.floor(amount * 100 + 0.5) / 100


def _floor_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num - F.pmod(num, den), den)


# two factors up to here keep twice their product inside a bigint
_SAFE = 2_000_000_000


def share_cents(paid: Column, part: Column, total: Column) -> Column:
    """``paid * part / total`` in cents, rounded half up; null if total <= 0."""

    def half_up(kind: str) -> Column:
        p, a, t = (c.cast(kind) for c in (paid, part, total))
        return _floor_div(2 * p * a + t, 2 * t).cast("bigint")

    small = F.greatest(F.abs(paid), F.abs(part), F.abs(total)) <= _SAFE
    return (
        F.when(total <= 0, F.lit(None).cast("bigint"))
        .when(small, half_up("bigint"))
        .otherwise(half_up("decimal(18,0)"))
    )
