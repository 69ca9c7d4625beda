"""Counts, extremes and summaries by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.hygiene import quoted


def value_counts(df: DataFrame, column: str, name: str = "Count") -> DataFrame:
    """Rows per value; missing values are not counted."""
    value = F.col(quoted(column))
    return df.where(value.isNotNull()).groupBy(value.alias(column)).agg(
        F.count(F.lit(1)).alias(name)
    )


def top_values(df: DataFrame, column: str, n: int = 10, name: str = "Count") -> DataFrame:
    """The ``n`` most frequent values, rarest first; equal counts go by value."""
    best = value_counts(df, column, name).orderBy(F.desc(name), quoted(column)).limit(n)
    return best.orderBy(name, F.desc(quoted(column)))


def dense_counts(
    df: DataFrame, column: str, categories: Sequence, name: str = "Count"
) -> DataFrame:
    """Rows per listed category in the listed order; a category without rows counts 0.

    Values outside the list are not counted. The list is an argument, so the counts that meet it
    are at most its length.
    """
    categories = list(categories)
    value = F.col(quoted(column))
    order = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(categories)], ["_order", column]
    )
    counts = value_counts(df.where(value.isin(categories)), column, name)
    joined = order.join(F.broadcast(counts), column, "left").orderBy("_order")
    return joined.select(quoted(column), F.coalesce(F.col(name), F.lit(0)).alias(name))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct().orderBy(quoted(column))


def distinct_count(df: DataFrame, column: str, relative_sd: float | None = None) -> Column:
    """Number of distinct values, exact unless a relative standard deviation is given."""
    value = F.col(quoted(column))
    return F.count_distinct(value) if relative_sd is None else F.approx_count_distinct(value, relative_sd)


def best_by(scores: DataFrame, score: str, key: str) -> DataFrame:
    """The row with the highest score; equal scores go to the least key."""
    return scores.orderBy(F.desc(score), key).limit(1)


def mean_point(df: DataFrame, lat: str = "Start_Lat", lng: str = "Start_Lng") -> DataFrame:
    return df.agg(
        F.avg(quoted(lat)).alias("center_lat"), F.avg(quoted(lng)).alias("center_lng")
    )


def hotspot_summary(
    df: DataFrame,
    cluster: str = S.CLUSTER,
    severity: str = S.SEVERITY,
    lat: str = "Start_Lat",
    lng: str = "Start_Lng",
    digits: int = 4,
) -> DataFrame:
    """Size, mean severity, mean position and bounding box of each cluster, by cluster."""
    figures = {
        "average_severity": F.avg(quoted(severity)),
        "average_latitude": F.avg(quoted(lat)),
        "average_longitude": F.avg(quoted(lng)),
        "minimum_latitude": F.min(quoted(lat)),
        "maximum_latitude": F.max(quoted(lat)),
        "minimum_longitude": F.min(quoted(lng)),
        "maximum_longitude": F.max(quoted(lng)),
    }
    return (
        df.where(F.col(quoted(cluster)).isNotNull())
        .groupBy(F.col(quoted(cluster)).alias(S.CLUSTER))
        .agg(
            F.count(F.lit(1)).alias("accident_count"),
            *[F.round(value, digits).alias(name) for name, value in figures.items()],
        )
        .orderBy(S.CLUSTER)
    )
