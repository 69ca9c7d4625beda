"""Raw incidents to cleaned incidents."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from mishap import schemas as S
from mishap.operators.hygiene import dedup, fill_constant, fill_numbers, medians, stage_profile
from mishap.sources.tables import stage


def _listed(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def clean(
    df: DataFrame,
    row_id: str = S.INCIDENT_ID,
    relative_error: float = 0.01,
    median_values: Mapping[str, float] | DataFrame | Callable[[DataFrame], Mapping[str, float]] | None = None,
) -> DataFrame:
    """Deduplicate, drop sparse columns, fill labels with a constant and measures with medians.

    Dropped columns go before the shuffle. The medians are a scalar subquery over the deduplicated
    rows; it shares the shuffle of the main plan, so the input is read and shuffled once. Medians
    that take jobs of their own are given as a function of the deduplicated rows, which are then
    written first: those jobs and the result read the written rows.
    """
    unique = dedup(df.drop(*S.DROPPED), [row_id])
    if callable(median_values):
        unique = stage(unique, "unique")
        median_values = median_values(unique)
    measured = _listed(unique, S.MEASURED)
    labelled = fill_constant(unique, _listed(unique, S.LABELLED))
    if not measured:
        return labelled
    if median_values is None:
        median_values = medians(unique, measured, relative_error)
    return fill_numbers(labelled, measured, median_values)


def profile(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows and columns before and after cleaning."""
    return stage_profile(raw, "raw").unionByName(stage_profile(cleaned, "cleaned"))
