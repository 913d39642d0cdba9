"""Row types of the warehouse. Money is DECIMAL(18,2), never double."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(spec: str) -> T.StructType:
    """A row type from "name kind, name kind"."""
    kinds = {"string": T.StringType(), "long": T.LongType(), "money": MONEY}
    fields = []
    for item in spec.split(", "):
        name, kind = item.split(" ")
        fields.append(T.StructField(name, kinds[kind]))
    return T.StructType(fields)


# The field names of logs, change messages, tables and topics.
COMMON = _struct(
    "ar string, ba string, ch string, md string, mid string, os string, uid string, "
    "vc string"
)
START = _struct(
    "entry string, loading_time long, open_ad_id long, open_ad_ms long, "
    "open_ad_skip_ms long"
)
LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", START),
    T.StructField("ts", T.LongType()),
])

# change envelopes; the rows inside stay JSON text until their table is known
CANAL = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("data", T.ArrayType(T.StringType())),
])
MAXWELL = _struct("type string, table string, data string")

ORDER_INFO = _struct(
    "id long, province_id long, order_status string, user_id long, "
    "final_total_amount money, benefit_reduce_amount money, "
    "original_total_amount money, feight_fee money, expire_time string, "
    "create_time string, operate_time string, create_date string, create_hour string, "
    "if_first_order string, province_name string, province_area_code string, "
    "province_iso_code string, user_age_group string, user_gender string"
)
ORDER_DETAIL = _struct(
    "id long, order_id long, sku_id long, order_price money, sku_num long, "
    "sku_name string, create_time string, spu_id long, tm_id long, category3_id long, "
    "spu_name string, tm_name string, category3_name string"
)
ORDER_WIDE = _struct(
    "order_detail_id long, order_id long, order_status string, create_time string, "
    "user_id long, sku_id long, sku_price money, sku_num long, sku_name string, "
    "benefit_reduce_amount money, feight_fee money, original_total_amount money, "
    "final_total_amount money, final_detail_amount money, if_first_order string, "
    "province_name string, province_area_code string, user_age_group string, "
    "user_gender string, dt string, spu_id long, tm_id long, category3_id long, "
    "spu_name string, tm_name string, category3_name string"
)
USER_INFO = _struct(
    "id string, user_level string, birthday string, gender string, age_group string, "
    "gender_name string"
)
PROVINCE_INFO = _struct("id string, name string, area_code string, iso_code string")
SKU_INFO = _struct(
    "id string, spu_id string, price string, sku_name string, tm_id string, "
    "category3_id string, create_time string, category3_name string, spu_name string, "
    "tm_name string"
)
SPU_INFO = _struct("id string, spu_name string")
TRADEMARK = _struct("tm_id string, tm_name string")
CATEGORY3 = _struct("id string, name string, category2_id string")
USER_STATUS = _struct("user_id string, if_consumed string")
DAU_INFO = _struct(
    "mid string, uid string, ar string, ch string, vc string, dt string, hr string, "
    "mi string, ts long"
)
