from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from brookmart.functions import clock, jsonrows, money, people, text
from brookmart.schemas import ORDER_INFO
from brookmart.session import work_dir


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_time_parts_around_midnight(spark):
    rows = spark.createDataFrame([(1616543999999,), (1616544000000,)], "ts bigint")
    got = [(r.dt, r.hr) for r in clock.with_log_time(rows).collect()]
    assert got == [("2021-03-23", "23"), ("2021-03-24", "00")]


def test_order_time_parts(spark):
    rows = spark.createDataFrame([("2021-03-31 10:28:32",), ("2021-03-31",), (None,)], "create_time string")
    got = [(r.create_date, r.create_hour) for r in clock.with_order_time(rows).collect()]
    assert got == [("2021-03-31", "10"), ("2021-03-31", None), (None, None)]


def test_previous_day_and_pad(spark):
    r = one(spark, clock.previous_day("2024-03-01").alias("d"), clock.pad_hour(F.lit(7)).alias("h"))
    assert (r.d, r.h) == ("2024-02-29", "07")


# ages in years of 365 days at 2024-01-01
@pytest.mark.parametrize("years, group", [
    (19, people.AGE_UP_TO_20), (20, people.AGE_21_TO_30),
    (30, people.AGE_21_TO_30), (31, people.AGE_OVER_30),
])
def test_age_bands(spark, years, group):
    born = F.date_format(F.date_sub(F.lit("2024-01-01").cast("date"), years * 365), "yyyy-MM-dd")
    users = spark.range(1).select(born.alias("birthday"), F.lit("M").alias("gender"))
    assert people.with_profile(users, "2024-01-01").first().age_group == group


def test_age_is_one_less_a_day_before(spark):
    born = F.date_format(F.date_sub(F.lit("2024-01-01").cast("date"), 20 * 365 - 1), "yyyy-MM-dd")
    assert one(spark, people.age(born, F.lit("2024-01-01").cast("date")).alias("a")).a == 19


def test_gender_names(spark):
    rows = spark.createDataFrame([("M",), ("F",), ("m",), (None,)], "gender string")
    got = [r.g for r in rows.select(people.gender_name(F.col("gender")).alias("g")).collect()]
    assert got == [people.MALE, people.FEMALE, people.FEMALE, people.FEMALE]


def test_round_cents_ties(spark):
    rows = spark.createDataFrame([(0.125,), (-0.125,), (2.5,)], "x double")
    got = [float(r.r) for r in rows.select(money.round_cents(F.col("x")).alias("r")).collect()]
    assert got == [0.13, -0.12, 2.5]


def test_share_cents(spark):
    rows = spark.createDataFrame([
        (100, 1, 3), (100, 1, 8), (-100, 1, 8), (100, 5, 0), (100, 0, 10),
        (9_000_000_000_000, 3_000_000_000_000, 7_000_000_000_000),
    ], "p bigint, a bigint, t bigint")
    got = [r.s for r in rows.select(money.share_cents(F.col("p"), F.col("a"), F.col("t")).alias("s")).collect()]
    # 12.5 goes up to 13, -12.5 up to -12; the last needs more than 64 bits
    assert got == [33, 13, -12, None, 0, (2 * 9 * 3 * 10**24 + 7 * 10**12) // (2 * 7 * 10**12)]


def test_from_cents(spark):
    r = one(spark, money.from_cents(F.lit(123456)).alias("m"), money.from_cents(F.lit(-5)).alias("n"))
    assert (r.m, r.n) == (Decimal("1234.56"), Decimal("-0.05"))


def test_parse_typed_defaults(spark):
    rows = spark.createDataFrame([('{"id":7,"final_total_amount":12.5,"order_status":null}', 3)], "value string, offset int")
    r = jsonrows.parse_typed(rows, ORDER_INFO, keep=("offset",)).first()
    assert (r.offset, r.id, r.user_id, r.final_total_amount, r.feight_fee) == (3, 7, 0, Decimal("12.50"), Decimal("0.00"))
    assert r.order_status is None and r.create_time is None


def test_json_round_trip(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, 5, None)], "id int, n int, s string")
    got = [r.v for r in rows.select(jsonrows.as_json(*rows.columns).alias("v")).collect()]
    assert got == ['{"id":1,"s":"x"}', '{"id":2,"n":5}']


def test_words_are_whole_and_in_any_script(spark):
    rows = spark.createDataFrame([("The théme, the-other THE.",), ("",), (None,)], "t string")
    got = [r.n for r in rows.select(text.word_count(F.col("t"), "the").alias("n")).collect()]
    assert got[:2] == [3, 0] and got[2] in (None, -1)


class Session:
    """Stands for a session with the given master and checkpoint folder."""

    def __init__(self, master, folder):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_work_dir_follows_the_cluster_setting():
    cluster = Session("yarn", "hdfs://shared/checkpoints/")
    path = work_dir(cluster, "x")
    assert path.startswith("hdfs://shared/checkpoints/brookmart/x-")
    assert path != work_dir(cluster, "x")


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    with pytest.raises(ValueError):
        work_dir(Session("yarn", None), "x")
    assert work_dir(Session("local[2]", None), "x")
