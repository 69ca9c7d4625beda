"""Incident tables built from the given order tables, in Spark and in SQL.

The given tables hold no incidents, so an order line plays one: its order gives severity and start
time, its own numbers the position, weather and road flags. Line keys repeat, and conditions leave
gaps in most columns. Each expression is written once and is valid in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap import schemas as S

# Column: expression over lineitem joined with orders.
EXPRESSIONS = {
    "ID": "concat(l_orderkey, '-', l_linenumber)",
    "Severity": "CASE WHEN l_quantity > 35 THEN 4 WHEN l_quantity < 12 AND l_tax < 0.05 THEN 1"
    " WHEN o_orderpriority = '2-HIGH' THEN 3 ELSE 2 END",
    "Start_Lat": "32e0 + l_discount * 100",
    "Start_Lng": "-124e0 + l_tax * 50",
    "End_Lat": "l_discount",
    "End_Lng": "CASE WHEN l_tax > 0.04 THEN l_tax END",
    "Distance(mi)": "l_quantity / 10",
    "Street": "concat('Street ', l_suppkey)",
    "City": "concat('City ', l_linenumber)",
    "County": "concat('County ', o_orderstatus)",
    "State": "CASE o_orderstatus WHEN 'F' THEN 'CA' WHEN 'O' THEN 'OH' END",
    "Timezone": "CASE l_linestatus WHEN 'O' THEN 'US/Pacific' END",
    "Temperature(F)": "CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / 1000 END",
    "Wind_Chill(F)": "l_tax",
    "Humidity(%)": "CASE WHEN l_linestatus = 'F' THEN l_quantity * 2 END",
    "Pressure(in)": "CASE WHEN l_quantity > 3 THEN 28 + l_discount * 20 END",
    "Visibility(mi)": "CASE WHEN l_tax > 0 THEN l_quantity / 5 END",
    "Wind_Direction": "CASE l_returnflag WHEN 'A' THEN 'West' WHEN 'R' THEN 'Calm' END",
    "Wind_Speed(mph)": "CASE WHEN l_discount > 0.01 THEN l_tax * 100 END",
    "Precipitation(in)": "l_discount",
    "Weather_Condition": "CASE WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 20 THEN 'Rain'"
    " WHEN l_quantity < 30 THEN 'Fog' WHEN l_quantity < 40 THEN 'Clear' ELSE 'Cloudy' END",
    "Amenity": "l_quantity > 40",
    "Bump": "l_tax > 0.07",
    "Crossing": "l_discount > 0.05",
    "Give_Way": "l_linenumber = 7",
    "Junction": "l_linestatus = 'O'",
    "Railway": "CASE WHEN l_returnflag <> 'N' THEN l_tax < 0.02 END",
    "Roundabout": "l_quantity = 1",
    "Stop": "l_extendedprice > 90000",
    "Traffic_Signal": "o_orderstatus = 'F'",
    "Station": "o_totalprice > 300000",
    "Sunrise_Sunset": "CASE l_linestatus WHEN 'F' THEN 'Day' END",
    "Civil_Twilight": "CASE WHEN l_linenumber <= 3 THEN 'Day' WHEN l_linenumber <= 6 THEN 'Night' END",
    "Nautical_Twilight": "o_orderstatus",
    "Astronomical_Twilight": "CASE o_orderstatus WHEN 'F' THEN 'Night' END",
}

# Column: (base timestamp, seconds to add, condition), over the same join.
TIMES = {
    "Start_Time": ("o_orderdate", "CAST(floor(l_extendedprice) AS BIGINT) * 60 % 86400", "TRUE"),
    "End_Time": (
        "l_shipdate",
        "CAST(floor(l_extendedprice) AS BIGINT) * 7 % 86400",
        "l_returnflag <> 'A' OR l_linenumber > 2",
    ),
    "Weather_Timestamp": ("o_orderdate", "0", "TRUE"),
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incidents with the raw schema. Orders grow with the lines, so the join is by shuffle."""
    lines, orders = tables(spark, sf_dir, "lineitem", "orders")
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    columns = {name: F.expr(text) for name, text in EXPRESSIONS.items()}
    for name, (base, seconds, condition) in TIMES.items():
        moment = f"timestampadd(SECOND, {seconds}, {base})"
        columns[name] = F.expr(f"CASE WHEN {condition} THEN {moment} END")
    return joined.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in S.RAW.fields]
    )


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def incidents_sql() -> str:
    """The same table as a SELECT."""
    columns = dict(EXPRESSIONS)
    for name, (base, seconds, condition) in TIMES.items():
        columns[name] = f"CASE WHEN {condition} THEN {base} + to_seconds({seconds}) END"
    listed = ", ".join(f'{columns[n]} AS "{n}"' for n in S.RAW.names)
    return f"SELECT {listed} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def cleaned_sql() -> str:
    """The cleaned table with exact lower medians as a SELECT."""
    kept = [n for n in S.RAW.names if n not in S.DROPPED]
    order = ", ".join(f'"{n}" ASC NULLS FIRST' for n in kept if n != "ID")
    out = []
    for n in kept:
        if n in S.LABELLED:
            out.append(f"coalesce(\"{n}\", 'Unknown') AS \"{n}\"")
        elif n in S.MEASURED:
            out.append(f'coalesce("{n}", (SELECT quantile_disc("{n}", 0.5) FROM deduped)) AS "{n}"')
        else:
            out.append(f'"{n}"')
    return f"""
WITH raw AS ({incidents_sql()}),
ranked AS (SELECT {_quoted(kept)},
                  row_number() OVER (PARTITION BY "ID" ORDER BY {order}) AS pick
           FROM raw),
deduped AS (SELECT {_quoted(kept)} FROM ranked WHERE pick = 1)
SELECT {', '.join(out)} FROM deduped"""


CALENDAR_SQL = """
CAST(year({t}) AS INTEGER) AS "Accident_Year",
CAST(month({t}) AS INTEGER) AS "Accident_Month",
CAST(dayofweek({t}) + 1 AS INTEGER) AS "Accident_DayOfWeek",
CAST(hour({t}) AS INTEGER) AS "Accident_Hour",
CASE WHEN dayofweek({t}) IN (0, 6) THEN 1 ELSE 0 END AS "Is_Weekend",
CASE WHEN dayofweek({t}) NOT IN (0, 6)
      AND ((hour({t}) >= 7 AND hour({t}) < 10) OR (hour({t}) >= 16 AND hour({t}) < 19))
     THEN 1 ELSE 0 END AS "Is_Rush_Hour"
"""

DURATION_SQL = (
    "CASE WHEN floor(epoch({e})) - floor(epoch({s})) >= 0 "
    "THEN round((floor(epoch({e})) - floor(epoch({s}))) / 60.0, 2) END"
)


def engineered_sql() -> str:
    """The engineered table as a SELECT."""
    out = [f'"{n}"' for n in S.ENGINEERED if n not in S.CALENDAR and n != S.DURATION]
    out.append(CALENDAR_SQL.format(t='"Start_Time"'))
    duration = DURATION_SQL.format(s='"Start_Time"', e='"End_Time"')
    out.append(f'{duration} AS "{S.DURATION}"')
    return f"SELECT {', '.join(out)} FROM ({cleaned_sql()}) AS cleaned"
