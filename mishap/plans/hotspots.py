"""Hotspots: k-means over standardised features, k chosen by silhouette, summary per cluster."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from mishap import schemas as S
from mishap.operators.aggregates import best_by, hotspot_summary
from mishap.operators.clustering import (
    Scaling,
    as_vectors,
    assign_clusters,
    fit_scaling,
    scaled_points,
    sweep,
)


@dataclass(frozen=True)
class Hotspots:
    """The fitted sweep. Centres are in standardised units, clusters numbered in centre order."""

    features: Sequence[str]
    scaling: Scaling
    centres: dict[int, list[list[float]]]
    evaluation: DataFrame
    best_k: int

    @property
    def skipped_rows(self) -> int:
        """Rows that lack a feature: they keep their place in the table without a cluster."""
        return self.scaling.rows - self.scaling.complete_rows

    def assign(self, df: DataFrame, name: str = S.CLUSTER) -> DataFrame:
        return assign_clusters(df, self.features, self.centres[self.best_k], self.scaling, name)


def fit_hotspots(
    df: DataFrame,
    features: Sequence[str] = tuple(S.CLUSTER_FEATURES),
    counts: Iterable[int] = S.CLUSTER_COUNTS,
    seed: int = S.SEED,
    max_iter: int = 20,
    parallelism: int = 6,
) -> Hotspots:
    """Scale, then fit and score every k.

    Only the features are read and held, as one vector per point. The fits and the scores share
    that copy, which is released at the end.
    """
    scaling = fit_scaling(df, features)
    vectors = as_vectors(scaled_points(df, features, scaling), features).persist()
    try:
        models = sweep(vectors, features, counts, seed, max_iter, parallelism)
    finally:
        vectors.unpersist()
    scores = [(k, score) for k, (_, score) in models.items()]
    evaluation = df.sparkSession.createDataFrame(scores, S.EVALUATION).orderBy("k")
    best_k = best_by(evaluation, "silhouette_score", "k").first()["k"]
    centres = {k: found for k, (found, _) in models.items()}
    return Hotspots(features, scaling, centres, evaluation, best_k)


def summarise(clustered: DataFrame) -> DataFrame:
    return hotspot_summary(clustered)
