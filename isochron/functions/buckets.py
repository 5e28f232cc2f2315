"""Labels for ranges of values. Bounds and labels are fixed values; null stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isochron.fixed_values import HOLIDAY_TYPES, PRECIPITATION_LABELS, TEMPERATURE_LABELS, WIND_LABELS


def _labelled(value: Column, labels: list[str], below: list[Column]) -> Column:
    """The label of the first condition that holds, the last label if none does."""
    chain = F.when(value.isNull(), F.lit(None))
    for label, condition in zip(labels, below):
        chain = chain.when(condition, label)
    return chain.otherwise(labels[-1])


def temperature_category(temp: Column) -> Column:
    return _labelled(temp, TEMPERATURE_LABELS, [temp < bound for bound in (0, 10, 20, 30)])


def precipitation_category(mm: Column) -> Column:
    return _labelled(mm, PRECIPITATION_LABELS, [mm <= bound for bound in (0, 1, 5)])


def wind_category(kph: Column) -> Column:
    return _labelled(kph, WIND_LABELS, [kph <= bound for bound in (15, 30)])


def weather_severity(temp: Column) -> Column:
    return F.when(temp < 0, "cold").when(temp > 30, "hot").when(temp.isNotNull(), "moderate")


def season(month: Column) -> Column:
    return (
        F.when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .when(month.between(9, 11), "autumn")
        .otherwise("winter")
    )


def is_daylight(hour: Column) -> Column:
    return F.when(hour.between(6, 20), 1).otherwise(0)


def holiday_category(kind: Column) -> Column:
    chain = F
    for category, kinds in HOLIDAY_TYPES.items():
        chain = chain.when(kind.isin(kinds), category)
    return chain.otherwise("other")


def holiday_season(day: Column) -> Column:
    month, dom = F.month(day), F.dayofmonth(day)
    return (
        F.when((month == 12) & dom.between(24, 31), "christmas_week")
        .when((month == 1) & (dom == 1), "new_year")
        .when((month == 12) & dom.between(15, 23), "pre_christmas")
        .when(month.isin(7, 8), "summer_holidays")
        .when((month == 4) & dom.between(1, 15), "spring_holidays")
        .otherwise("regular_holiday")
    )


def performance_rating(rmse: Column) -> Column:
    """Forecast quality by RMSE; a missing RMSE is 'Unrated'."""
    return (
        F.when(rmse.isNull(), "Unrated")
        .when(rmse < 100, "Excellent")
        .when(rmse < 500, "Good")
        .when(rmse < 1000, "Fair")
        .otherwise("Poor")
    )
