"""Expressions that turn codes into labels and labels into display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mishap import schemas as S

FEATURE_PREFIXES = ("numerical__", "categorical__", "binary__")


def risk_class(severity: Column, classes: dict | None = None) -> Column:
    """Risk class of a severity; a severity outside the mapping has none."""
    result = None
    for code, label in (classes or S.RISK_OF_SEVERITY).items():
        hit = severity == code
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result


def severity_label(severity: Column) -> Column:
    return F.concat(F.lit("Severity "), severity.cast("string"))


def feature_title(feature: Column) -> Column:
    """Model feature name as display text: group prefix off, underscores to spaces."""
    for prefix in FEATURE_PREFIXES:
        feature = F.replace(feature, F.lit(prefix), F.lit(""))
    return F.replace(feature, F.lit("_"), F.lit(" "))


def present(column: Column) -> Column:
    """Number as double with NaN treated as missing."""
    return F.nullif(column.cast("double"), F.lit(float("nan")))
