"""Report tables over the results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.functions.labels import feature_title, severity_label
from mishap.operators.aggregates import (
    best_by,
    dense_counts,
    distinct_sorted,
    mean_point,
    top_values,
    value_counts,
)
from mishap.operators.hygiene import quoted
from mishap.operators.sampling import exact_sample, least_hashed
from mishap.sources.tables import stage

ALL = "All"
HEADLINE = ("balanced_accuracy", "accuracy", "testing_records")


def headline_metrics(
    metrics: DataFrame | None, like: DataFrame, defaults: Mapping[str, float] | None = None
) -> DataFrame:
    """Headline metrics (metric, value); one that is absent shows its default, null if none is given."""
    given = defaults or {}
    rows = [(name, given.get(name)) for name in HEADLINE]
    wanted = like.sparkSession.createDataFrame(rows, "metric string, fallback double")
    if metrics is None:
        return wanted.withColumnRenamed("fallback", "value")
    found = metrics.where((F.col("class") == "all") & F.col("metric").isin(list(HEADLINE)))
    joined = wanted.join(found.select("metric", "value"), "metric", "left")
    return joined.select("metric", F.coalesce("value", "fallback").alias("value"))


def kpis(
    clustered: DataFrame,
    evaluation: DataFrame,
    metrics: DataFrame | None = None,
    defaults: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row: incidents, hotspots, best k with its silhouette, and the model's accuracies.

    Without metrics the accuracies are those of ``defaults``, or null.
    """
    counts = clustered.agg(
        F.count(F.lit(1)).alias("analyzed_incidents"),
        F.count_distinct(S.CLUSTER).alias("identified_hotspots"),
    )
    best = best_by(evaluation, "silhouette_score", "k").select(F.struct("k", "silhouette_score")).scalar()
    headline = headline_metrics(metrics, clustered, defaults)

    def value(name: str):
        return headline.where(F.col("metric") == name).select("value").scalar()

    return counts.select(
        "*",
        best["silhouette_score"].alias("best_silhouette"),
        best["k"].alias("best_k"),
        value("balanced_accuracy").alias("balanced_accuracy"),
        value("accuracy").alias("overall_accuracy"),
        value("testing_records").cast("long").alias("testing_records"),
    )


def cluster_choices(clustered: DataFrame) -> DataFrame:
    return distinct_sorted(clustered, S.CLUSTER)


def hotspot_table(summary: DataFrame) -> DataFrame:
    """The hotspot summary under its presentation names."""
    return summary.withColumnsRenamed(S.HOTSPOT_TITLES)


def evaluation_curve(evaluation: DataFrame) -> DataFrame:
    """Silhouette per k, with the selected k marked."""
    best = best_by(evaluation, "silhouette_score", "k").select("k").scalar()
    return evaluation.select("k", "silhouette_score", (F.col("k") == best).alias("selected")).orderBy("k")


def predicted_risk(predictions: DataFrame, classes: Sequence[str] = tuple(S.RISK_CLASSES)) -> DataFrame:
    counts = dense_counts(predictions, S.PREDICTED_RISK, classes)
    return counts.withColumnRenamed(S.PREDICTED_RISK, "Risk")


def severity_distribution(df: DataFrame, severity: str = S.SEVERITY) -> DataFrame:
    counts = value_counts(df, severity).orderBy(quoted(severity))
    return counts.withColumn("Severity_Label", severity_label(F.col(quoted(severity))))


def incidents_by_hour(df: DataFrame, hour: str = "Accident_Hour") -> DataFrame:
    counts = value_counts(df, hour, "Accidents").orderBy(quoted(hour))
    return counts.withColumnRenamed(hour, "Hour")


def top_weather(df: DataFrame, column: str = "Weather_Condition", n: int = 10) -> DataFrame:
    return top_values(df, column, n, "Accidents").withColumnRenamed(column, "Weather")


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most important features with display names, least important first."""
    best = importance.orderBy(F.desc("importance"), "feature").limit(n)
    titled = best.withColumn("display_feature", feature_title(F.col("feature")))
    return titled.orderBy("importance", F.desc("feature"))


def first_predictions(predictions: DataFrame, row_id: str = S.INCIDENT_ID, n: int = 100) -> DataFrame:
    """The first ``n`` predictions by id, with those display columns that the table has."""
    shown = [c for c in S.PREDICTION_DISPLAY if c in predictions.columns]
    return predictions.orderBy(quoted(row_id)).limit(n).select(*[quoted(c) for c in shown])


def in_cluster(df: DataFrame, choice=ALL, cluster: str = S.CLUSTER) -> DataFrame:
    """Rows of one cluster, or every row."""
    return df if choice == ALL else df.where(F.col(quoted(cluster)) == F.lit(choice))


def map_sample(
    clustered: DataFrame,
    choice=ALL,
    limit: int = 5000,
    seed: int = S.SEED,
    row_id: str = S.INCIDENT_ID,
    columns: Sequence[str] = ("Start_Lat", "Start_Lng", "ID", "Severity", "cluster_id"),
    cluster: str = S.CLUSTER,
) -> DataFrame:
    """Marker rows for a map: an exact-size sample of one cluster or of all."""
    chosen = in_cluster(clustered, choice, cluster)
    return exact_sample(chosen, row_id, limit, seed).select(*[quoted(c) for c in columns])


def map_samples(
    clustered: DataFrame,
    limit: int = 5000,
    seed: int = S.SEED,
    row_id: str = S.INCIDENT_ID,
    columns: Sequence[str] = ("Start_Lat", "Start_Lng", "ID", "Severity", "cluster_id"),
    cluster: str = S.CLUSTER,
) -> DataFrame:
    """The marker rows of every choice of a map, in one pass: ``choice`` is a cluster's name or "All".

    Each choice has the rows that ``map_sample`` gives where ids are unique. The first rows of the whole table are among
    those of its clusters, so they come from the clusters' samples.
    """
    wanted = list(dict.fromkeys([*columns, row_id, cluster]))
    each = stage(least_hashed(clustered.select(*map(quoted, wanted)), row_id, cluster, limit, seed), "markers")
    whole = least_hashed(each, row_id, None, limit, seed)
    names = [quoted(c) for c in columns]
    return (
        each.where(F.col(quoted(cluster)).isNotNull())
        .select(F.col(quoted(cluster)).cast("string").alias("choice"), *names)
        .unionByName(whole.select(F.lit(ALL).alias("choice"), *names))
    )


def map_center(markers: DataFrame, lat: str = "Start_Lat", lng: str = "Start_Lng") -> DataFrame:
    return mean_point(markers, lat, lng)
