"""Demographic labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper age bound (exclusive) and label of each band, and the gender labels.
AGE_BANDS = ((18, "0-17岁"), (46, "18-45岁"), (70, "46-69岁"))
OLDEST_BAND = "70岁及以上"
GENDER_FEMALE = "女"
GENDER_OTHER = "男"
CHART_YOUNG, CHART_MIDDLE, CHART_OLD = "20岁以下", "20-30岁", "30岁以上"


def age(birthday: Column, as_of_year: int) -> Column:
    """Calendar-year age: only the year of ``birthday`` counts."""
    return F.lit(as_of_year) - F.substring_index(birthday, "-", 1).try_cast("int")


def age_band(years: Column) -> Column:
    band = F.when(years.isNull(), None)
    for bound, label in AGE_BANDS:
        band = band.when(years < bound, label)
    return band.otherwise(OLDEST_BAND)


def chart_age_band(years: Column) -> Column:
    """The three slices of the age chart: below 20, 20 to 30, above 30."""
    return (
        F.when(years.isNull(), None)
        .when(years < 20, CHART_YOUNG)
        .when(years <= 30, CHART_MIDDLE)
        .otherwise(CHART_OLD)
    )


def gender_name(gender: Column) -> Column:
    return F.when(gender == "F", GENDER_FEMALE).otherwise(GENDER_OTHER)
