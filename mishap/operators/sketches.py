"""Order statistics from mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap.functions.labels import present

# Sketches of tasks are first merged within this many groups of tasks, then across the groups.
SALTS = 64
MOST = 65_535


def sketch_size(relative_error: float) -> int:
    """Size of a KLL sketch whose ranks are off by less than the error.

    The published bound is 2.296 / k ** 0.9021 with a confidence of 99 %. It is asked for half the
    error, that is, at five standard deviations.
    """
    return min(MOST, max(8, round((4.592 / relative_error) ** (1 / 0.9021))))


def sketches(
    df: DataFrame, columns: Sequence[str], relative_error: float, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., s0, s1, ...): a sketch of every column per group, in one pass.

    Missing values and NaN do not enter. What a task reports has a size that depends on the error
    alone; reports go to ``SALTS`` groups of tasks, and one sketch per group goes on, so the last
    merge reads the same however many tasks there were.
    """
    size = sketch_size(relative_error)
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")
    keys = [F.col(_quoted(c)).alias(f"_by{i}") for i, c in enumerate(by)]
    named = {f"s{i}": present(F.col(_quoted(c))) for i, c in enumerate(columns)}
    values = df.select(*keys, salt, *[v.alias(n) for n, v in named.items()])
    groups = [f"_by{i}" for i in range(len(by))]
    first = values.groupBy(*groups, "_salt").agg(
        *[F.call_function("kll_sketch_agg_double", F.col(n), F.lit(size)).alias(n) for n in named]
    )
    merged = first.groupBy(*groups).agg(*[merge(F.col(n)).alias(n) for n in named])
    return merged.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], *named)


def merge(sketch: Column) -> Column:
    """Aggregate: one sketch of all that the sketches have seen."""
    return F.call_function("kll_merge_agg_double", sketch)


def median(sketch: Column) -> Column:
    """A value of the column in the middle; null where the sketch has seen no value."""
    middle = F.call_function("kll_sketch_get_quantile_double", sketch, F.lit(0.5))
    return F.when(F.call_function("kll_sketch_get_n_double", sketch) > 0, middle)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
