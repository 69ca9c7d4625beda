"""Calendar, rush-hour and duration expressions over timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEEKEND_DAYS = (1, 7)
RUSH_HOURS = ((7, 10), (16, 19))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a session-zone timestamp; malformed text becomes null."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(column)
    return column.cast("timestamp")


def weekend_flag(day_of_week: Column) -> Column:
    """1 on Saturday and Sunday, 0 on any other day and when the day is missing."""
    return F.when(day_of_week.isin(*WEEKEND_DAYS), 1).otherwise(0)


def rush_hour_flag(day_of_week: Column, hour: Column) -> Column:
    """1 on a working day inside one of the half-open rush-hour ranges, otherwise 0."""
    in_range = F.lit(False)
    for start, stop in RUSH_HOURS:
        in_range = in_range | ((hour >= start) & (hour < stop))
    return F.when((weekend_flag(day_of_week) == 0) & in_range, 1).otherwise(0)


def calendar(ts: Column) -> dict[str, Column]:
    """Year, month, day of week (Sunday is 1), hour and the two flags of a timestamp."""
    day, hour = F.dayofweek(ts), F.hour(ts)
    return {
        "Accident_Year": F.year(ts),
        "Accident_Month": F.month(ts),
        "Accident_DayOfWeek": day,
        "Accident_Hour": hour,
        "Is_Weekend": weekend_flag(day),
        "Is_Rush_Hour": rush_hour_flag(day, hour),
    }


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps as minutes to two digits; null if negative or missing."""
    seconds = F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
    minutes = F.round(seconds / F.lit(60.0), 2)
    return F.when(minutes >= 0, minutes)
