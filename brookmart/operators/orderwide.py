"""Orders joined with their lines, and the amount paid spread over the lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brookmart.functions.money import cents, from_cents, share_cents
from brookmart.operators.hot import parts_of, per_part, running_sums, with_part

# Column names. Wide column -> column of the order
ORDER_COLUMNS = {
    "order_id": "id", "order_status": "order_status", "create_time": "create_time",
    "user_id": "user_id", "benefit_reduce_amount": "benefit_reduce_amount",
    "feight_fee": "feight_fee", "original_total_amount": "original_total_amount",
    "final_total_amount": "final_total_amount", "if_first_order": "if_first_order",
    "province_name": "province_name", "province_area_code": "province_area_code",
    "user_age_group": "user_age_group", "user_gender": "user_gender", "dt": "create_date",
}
# Column names. Wide column -> column of the line
DETAIL_COLUMNS = {
    "order_detail_id": "id", "order_id": "order_id", "sku_id": "sku_id",
    "sku_price": "order_price", "sku_num": "sku_num", "sku_name": "sku_name",
    "spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id",
    "spu_name": "spu_name", "tm_name": "tm_name", "category3_name": "category3_name",
    "detail_amount": "detail_amount", "original_total_amount": "original_total_amount", "_part": "_part",
}


def _renamed(rows: DataFrame, names: dict[str, str], more: tuple[str, ...] = ()) -> DataFrame:
    """The known columns that the rows have, under their wide names."""
    have = set(rows.columns)
    return rows.select(*[F.col(c).alias(n) for n, c in names.items() if c in have], *more)


def order_columns(orders: DataFrame, *more: str) -> DataFrame:
    return _renamed(orders, ORDER_COLUMNS, more)


def detail_columns(details: DataFrame, *more: str) -> DataFrame:
    return _renamed(details, DETAIL_COLUMNS, more)


def order_wide(orders: DataFrame, details: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """One row per order line with the columns of both sides.

    Both sides are shuffled once, on the order id. ``hot`` (see ``hot_keys``)
    names orders with so many lines that one task must not get them all; their
    lines are spread by ``_part``, which ``split_payment`` uses too, so that it
    needs no further shuffle. Lines that have a ``_part`` already keep it. The
    original amount is the order's, or the one its lines hold if it has none.
    """
    left, right, on = order_columns(orders), detail_columns(details), ["order_id"]
    if "original_total_amount" in left.columns:
        right = right.drop("original_total_amount")
    if hot is not None:
        if "_part" not in right.columns:
            right = with_part(right, "order_id", ["order_detail_id"], hot)
        left = per_part(left, "order_id", parts_of(right, "order_id"))
        on = ["order_id", "_part"]
    return left.join(right, on, "inner")


def line_amount(wide: DataFrame) -> Column:
    """Cents of a line: its stated amount if it has one, else price times number."""
    if "detail_amount" in wide.columns:
        return cents(F.col("detail_amount"))
    return cents(F.col("sku_price")) * F.col("sku_num")


def split_payment(wide: DataFrame, hot: DataFrame | None = None,
                  carried: DataFrame | None = None) -> DataFrame:
    """Add ``final_cents`` and ``final_detail_amount``, the line's part of the amount paid.

    A line gets paid * amount / original, rounded half up to the cent. The line
    at which the running amount reaches the order's original amount completes
    the order and gets what the lines before it left over, so a complete order
    adds up to the amount paid. Lines count in the order of their ids. An
    original amount of 0 gives null.

    ``carried`` holds ``(order_id, amount_before, given_before)`` in cents for
    orders some of whose lines came in earlier batches; without it, rows may have
    the two columns themselves. The result has the running ``amount_so_far`` and
    ``given_so_far`` columns to carry on.
    """
    rows = wide.withColumns({
        "_amount": line_amount(wide),
        "_paid": cents(F.col("final_total_amount")),
        "_original": cents(F.col("original_total_amount")),
    })
    if carried is not None:
        on = ["order_id"]
        if hot is not None:
            carried, on = per_part(carried, "order_id", parts_of(wide, "order_id")), ["order_id", "_part"]
        rows = rows.join(carried, on, "left")
    if "amount_before" not in rows.columns:
        before_amount = before_given = F.lit(0).cast("bigint")
    else:
        before_amount = F.coalesce("amount_before", F.lit(0).cast("bigint"))
        before_given = F.coalesce("given_before", F.lit(0).cast("bigint"))
    share = share_cents(F.col("_paid"), F.col("_amount"), F.col("_original"))
    rows = rows.withColumn("_share", share)
    rows = running_sums(rows, "order_id", ["order_detail_id"],
                        {"_amounts": F.col("_amount"),
                         "_shares": F.coalesce("_share", F.lit(0).cast("bigint"))}, hot is not None)
    rows = rows.withColumns({
        "amount_so_far": before_amount + F.col("_amounts"),
        "given_so_far": before_given + F.col("_shares"),
    })
    completes = (
        (F.col("amount_so_far") == F.col("_original"))
        & (F.col("amount_so_far") - F.col("_amount") != F.col("_original"))
        & (F.col("_original") > 0)
    )
    rest = F.col("_paid") - (F.col("given_so_far") - F.col("_share"))
    rows = rows.withColumn("final_cents", F.when(completes, rest).otherwise(F.col("_share")))
    return rows.withColumn("final_detail_amount", from_cents(F.col("final_cents"))).drop(
        "_amount", "_paid", "_original", "_share", "_amounts", "_shares", "amount_before", "given_before")
