"""The result tables of a run, by fixed names under one folder."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

CLEANED = "accidents_cleaned"
ENGINEERED = "accidents_engineered"
CLUSTERED = "accidents_clustered"
HOTSPOTS = "hotspot_summary"
EVALUATION = "kmeans_evaluation"
IMPORTANCE = "random_forest_feature_importance"
PREDICTIONS = "risk_predictions"
METRICS = "random_forest_metrics"
MODEL = "risk_model"


class Results(NamedTuple):
    clustered: DataFrame
    engineered: DataFrame
    hotspots: DataFrame
    evaluation: DataFrame
    importance: DataFrame
    predictions: DataFrame
    metrics: DataFrame


def load_results(spark: SparkSession, folder: str) -> Results:
    """Every result table of a run. The clustered table also serves as the engineered one."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}")

    clustered = table(CLUSTERED)
    return Results(
        clustered,
        clustered,
        table(HOTSPOTS),
        table(EVALUATION),
        table(IMPORTANCE),
        table(PREDICTIONS),
        table(METRICS),
    )
