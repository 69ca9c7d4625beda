import datetime as dt

import pytest
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.plans.engineering import engineer, with_calendar

MONDAY, SUNDAY = "2024-01-01", "2024-01-07"


def derived(spark, rows):
    df = spark.createDataFrame(rows, "ID string, Start_Time string, End_Time string")
    return {r["ID"]: r for r in with_calendar(df).collect()}


@pytest.mark.parametrize(
    "clock,rush",
    [
        ("06:59:59", 0),
        ("07:00:00", 1),
        ("09:59:59", 1),
        ("10:00:00", 0),
        ("15:59:59", 0),
        ("16:00:00", 1),
        ("18:59:59", 1),
        ("19:00:00", 0),
    ],
)
def test_rush_hour_bounds(spark, clock, rush):
    rows = derived(
        spark, [("workday", f"{MONDAY} {clock}", None), ("sunday", f"{SUNDAY} {clock}", None)]
    )
    assert rows["workday"]["Is_Rush_Hour"] == rush
    assert rows["sunday"]["Is_Rush_Hour"] == 0
    assert (rows["workday"]["Is_Weekend"], rows["sunday"]["Is_Weekend"]) == (0, 1)
    assert (rows["workday"]["Accident_DayOfWeek"], rows["sunday"]["Accident_DayOfWeek"]) == (2, 1)


def test_missing_and_malformed_start(spark):
    rows = derived(spark, [("null", None, f"{MONDAY} 10:00:00"), ("bad", "soon", f"{MONDAY} 10:00:00")])
    for row in rows.values():
        assert row["Accident_Hour"] is None and row["Accident_Year"] is None
        assert (row["Is_Weekend"], row["Is_Rush_Hour"]) == (0, 0)
        assert row[S.DURATION] is None


def test_duration(spark):
    start = f"{MONDAY} 10:00:00"
    rows = derived(
        spark,
        [
            ("negative", start, f"{MONDAY} 09:59:59"),
            ("equal", start, start),
            ("open", start, None),
            ("rounded", start, f"{MONDAY} 10:00:20"),
            ("fraction", start, f"{MONDAY} 10:01:00.987654321"),
        ],
    )
    got = {k: r[S.DURATION] for k, r in rows.items()}
    assert got == {"negative": None, "equal": 0.0, "open": None, "rounded": 0.33, "fraction": 1.0}


def test_timestamp_input_needs_no_parsing(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 3, 17, 5),)], "t timestamp_ntz")
    row = with_calendar(df, "t", None).first()
    assert (row["Accident_Month"], row["Accident_Hour"], row["Is_Weekend"]) == (2, 17, 1)


def test_engineered_columns(spark, sf):
    from checks.standin import incidents

    engineered = engineer(incidents(spark, sf))
    assert engineered.columns == S.ENGINEERED and len(engineered.columns) == 36
    assert engineered.schema.names == S.ENGINEERED_SCHEMA.names
    flags = engineered.agg(F.count_if(F.col("Is_Rush_Hour").isNull() | F.col("Is_Weekend").isNull()))
    assert flags.first()[0] == 0
