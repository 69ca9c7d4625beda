"""Cleaned incidents to the 36 columns that clustering and classification use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.functions.temporal import as_timestamp, calendar, duration_minutes
from mishap.operators.hygiene import quoted


def with_calendar(
    df: DataFrame, start: str = S.START_TIME, end: str | None = S.END_TIME
) -> DataFrame:
    """Add the calendar columns of the start time and, given an end time, the duration."""
    times = {"_start": as_timestamp(df, start)}
    if end:
        times["_end"] = as_timestamp(df, end)
    timed = df.withColumns(times)
    derived = calendar(F.col("_start"))
    if end:
        derived[S.DURATION] = duration_minutes(F.col("_start"), F.col("_end"))
    return timed.withColumns(derived).drop(*times)


def engineer(df: DataFrame) -> DataFrame:
    """The engineered table in its fixed column order. No shuffle."""
    return with_calendar(df).select(*[quoted(c) for c in S.ENGINEERED])
