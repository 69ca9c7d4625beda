"""Joining a large table with a side that is expected, but not known, to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from mishap.sources.tables import stage


def pin(df: DataFrame) -> DataFrame:
    """The result of a small aggregate, written so that later uses do not compute it again.

    A written table has a known size, by which Spark chooses between broadcast and shuffle.
    """
    return stage(df.coalesce(1), "pinned")


def join_small(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join that broadcasts ``small`` if its written size allows."""
    return big.join(pin(small), list(on), how)
