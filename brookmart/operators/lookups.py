"""Left lookups in dimension tables.

No broadcast is forced: Spark broadcasts a dimension whose measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and else sorts and merges, where
a hot key is split at run time (skew join). A key without a dimension row
leaves nulls. Dimension keys are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def lookup(rows: DataFrame, key: str, dim: DataFrame, dim_key: str,
           add: dict[str, Column]) -> DataFrame:
    """``rows`` with the columns ``add`` (expressions over the dimension) joined on."""
    right = dim.select(F.col(dim_key).alias("_key"), *[c.alias(n) for n, c in add.items()])
    left = rows.drop(*add)
    return left.join(right, left[key].cast("string") == right["_key"], "left").drop("_key")


def with_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    return lookup(orders, "province_id", provinces, "id", {
        "province_name": F.col("name"),
        "province_area_code": F.col("area_code"),
        "province_iso_code": F.col("iso_code"),
    })


def with_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    return lookup(orders, "user_id", users, "id", {
        "user_age_group": F.col("age_group"),
        "user_gender": F.col("gender_name"),
    })


def with_sku(details: DataFrame, skus: DataFrame, **more: Column) -> DataFrame:
    """Ids in the dimension are text; one that is not a number gives null.
    ``more`` adds further columns of the dimension."""
    return lookup(details, "sku_id", skus, "id", {
        "spu_id": F.col("spu_id").try_cast("bigint"),
        "tm_id": F.col("tm_id").try_cast("bigint"),
        "category3_id": F.col("category3_id").try_cast("bigint"),
        "spu_name": F.col("spu_name"),
        "tm_name": F.col("tm_name"),
        "category3_name": F.col("category3_name"),
        **more,
    })


def denormalize_sku(skus: DataFrame, trademarks: DataFrame, categories: DataFrame,
                    spus: DataFrame) -> DataFrame:
    """Names of brand, category and product line on each SKU."""
    out = lookup(skus, "category3_id", categories, "id", {"category3_name": F.col("name")})
    out = lookup(out, "tm_id", trademarks, "tm_id", {"tm_name": F.col("tm_name")})
    return lookup(out, "spu_id", spus, "id", {"spu_name": F.col("spu_name")})
