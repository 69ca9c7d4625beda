"""Deduplication, gap filling and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap import schemas as S
from mishap.operators.sketches import median, sketches


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the least row by ``order_by``, then by the remaining columns.

    Keeping only the first row lets Spark apply the limit inside each task before the shuffle, so a
    key that holds a large share of the table costs one row per task. Rows without a key form one
    group. Ordering by every column makes the result the same on every run.
    """
    rest = list(order_by) + [c for c in df.columns if c not in keys and c not in order_by]
    by_key = W.partitionBy(*[quoted(k) for k in keys])
    first = F.row_number().over(by_key.orderBy(*[quoted(c) for c in rest or keys]))
    return df.withColumn("_place", first).where("_place = 1").drop("_place")


def fill_constant(df: DataFrame, columns: Sequence[str], value: str = S.UNKNOWN) -> DataFrame:
    return df.fillna({c: value for c in columns})


def medians(df: DataFrame, columns: Sequence[str], relative_error: float = 0.01) -> DataFrame:
    """One row with the approximate median of every column, found in one pass.

    A median is a value of the column; missing values and NaN do not count, and a column without
    values has a null median. What tasks report is a sketch whose size depends on the error, not
    on their rows, and is merged in two stages. Up to some hundred values (thousands for small
    errors) the sketch holds all of them; beyond, it samples, so two runs may differ within the error.
    As the first merge goes by groups of tasks, Spark takes the result for nondeterministic: write it
    (``joins.pin``) before using it inside an aggregate.
    """
    found = sketches(df, columns, relative_error)
    return found.select(*[median(F.col(f"s{i}")).alias(c) for i, c in enumerate(columns)])


def fill_numbers(
    df: DataFrame, columns: Sequence[str], values: Mapping[str, float] | DataFrame
) -> DataFrame:
    """Fill gaps and NaN of numeric columns, from a mapping or from a one-row table.

    A table is read through a scalar subquery, so filling stays one lazy plan. A column whose value
    is missing is left as it is.
    """
    if isinstance(values, DataFrame):
        row = values.select(F.struct(*[F.col(quoted(c)) for c in columns]).alias("v")).scalar()
        value_of = {c: row.getField(c) for c in columns}
    else:
        value_of = {c: F.lit(values[c]) for c in columns if values.get(c) is not None}
    filled = {}
    for c, value in value_of.items():
        dtype = df.schema[c].dataType
        column: Column = F.col(quoted(c))
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            column = F.nullif(column, F.lit(float("nan")).cast(dtype))
        filled[c] = F.coalesce(column, value.cast(dtype))
    return df.withColumns(filled) if filled else df


def missing_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in columns]


def missing_report(df: DataFrame) -> DataFrame:
    """Columns that still have missing values, with their number; one pass over the table."""
    counts = df.agg(*missing_counts(df.columns))
    long = counts.unpivot([], [F.col(quoted(c)) for c in df.columns], "column", "missing")
    return long.where(F.col("missing") > 0)


def stage_profile(df: DataFrame, stage: str) -> DataFrame:
    """Row and column count of a stage."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(stage).alias("stage"), "rows", F.lit(len(df.columns)).alias("cols")
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """Name, type and position of every column."""
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")
