"""Fill values, value dictionaries and class weights learned from training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.operators.hygiene import quoted
from mishap.operators.joins import pin
from mishap.operators.numbering import numbered
from mishap.sources.tables import stage


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) of several columns in one pass; missing values are not counted."""
    text = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns])
    long = text.unpivot([], [F.col(quoted(c)) for c in columns], "column", "value")
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """Most frequent value per column; equal counts go to the least value."""
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
    return counts.groupBy("column").agg(best.alias("b")).select("column", "b.value")


def dictionary(counts: DataFrame) -> DataFrame:
    """(column, value, n, place): every value with its number, from 0, in its column's value order.

    Values are numbered by ranges and prefix sums, so a column may have any number of them.
    """
    placed = numbered(counts.select("column", "value", "n"), ["column", "value"], "_at")
    first = placed.groupBy("column").agg(F.min("_at").alias("_first"))
    joined = placed.join(pin(first), "column")
    return stage(
        joined.select("column", "value", "n", (F.col("_at") - F.col("_first")).alias("place")), "dictionary"
    )


def class_weights(counts: DataFrame) -> DataFrame:
    """Size and balanced weight of each class, from its count: every class gets the same total."""
    overall = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weight = overall["n"] / (overall["k"] * F.col("n"))
    return counts.select("value", F.col("n").alias("rows"), weight.alias("weight"))
