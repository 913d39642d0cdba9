"""Age band and gender name of a user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The labels stored with a user.
AGE_UP_TO_20 = "20岁及以下"
AGE_21_TO_30 = "21岁到30岁"
AGE_OVER_30 = "30岁以上"
MALE = "男"
FEMALE = "女"


def age(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days; leap days are not counted."""
    return F.call_function("div", F.datediff(as_of, F.to_date(birthday)), F.lit(365))


def age_group(years: Column) -> Column:
    """20 itself belongs to the middle band, in spite of the label."""
    return (
        F.when(years < 20, AGE_UP_TO_20)
        .when(years > 30, AGE_OVER_30)
        .when(years.isNotNull(), AGE_21_TO_30)
    )


def gender_name(gender: Column) -> Column:
    return F.when(gender == "M", MALE).otherwise(FEMALE)


def with_profile(users: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add ``age_group`` and ``gender_name``; ``as_of`` defaults to today."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return users.withColumns({
        "age_group": age_group(age(F.col("birthday"), day)),
        "gender_name": gender_name(F.col("gender")),
    })
