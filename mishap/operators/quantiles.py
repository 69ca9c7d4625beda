"""Exact order statistics of large columns without sorting them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap.functions.labels import present
from mishap.operators.hygiene import quoted

GRID_STEPS = 1_000
GRID_ACCURACY = 4_000
SLACK = 2
SKETCH_GROUPS = 64
FINAL_ROWS = 10_000


@dataclass
class _Target:
    """The ``rank``-th smallest value of a column, known to lie strictly between two bounds."""

    column: str
    rank: int = 0
    low: float | None = None
    high: float | None = None
    below: int = 0
    rows: int | None = None
    value: float | None = None
    # Values to test next, expected to enclose the target.
    candidates: tuple[float, float] | None = None

    @property
    def countable(self) -> bool:
        """Few enough rows are left to fetch their values."""
        return self.candidates is None and self.rows is not None and self.rows <= FINAL_ROWS

    def inside(self, values: Column) -> Column:
        kept = values.isNotNull()
        if self.low is not None:
            kept = kept & (values > self.low)
        if self.high is not None:
            kept = kept & (values < self.high)
        return kept

    def measures(self) -> dict[str, Column]:
        """What one pass finds out: counts around the candidates, and a grid between them."""
        values = present(F.col(quoted(self.column)))
        kept = self.inside(values)
        found = {}
        if self.candidates:
            low, high = self.candidates
            found = {
                "lt_low": F.count_if(values < low),
                "to_low": F.count_if(values <= low),
                "lt_high": F.count_if(values < high),
                "to_high": F.count_if(values <= high),
            }
            kept = kept & (values > low) & (values < high)
        inner = F.when(kept, values)
        steps = F.lit(np.linspace(0.0, 1.0, GRID_STEPS + 1))
        found["grid"] = F.percentile_approx(inner, steps, GRID_ACCURACY)
        found["rows"] = F.count(inner)
        return found

    def narrow(self, found: dict) -> None:
        """Use what a pass found to pick the answer or a narrower open interval."""
        if self.candidates is None:
            self._plan(found)
            return
        low, high = self.candidates
        self.candidates = None
        if self.rank <= found["lt_low"]:
            self.high, self.rows = low, None
        elif self.rank <= found["to_low"]:
            self.value = low
        elif self.rank > found["to_high"]:
            self.low, self.below, self.rows = high, found["to_high"], None
        elif self.rank > found["lt_high"]:
            self.value = high
        else:
            self.low, self.high, self.below = low, high, found["to_low"]
            self._plan(found)

    def _plan(self, found: dict) -> None:
        """Choose the next values to test around the rank's place in the grid."""
        self.rows = found["rows"]
        if not self.countable:
            values, upto = found["grid"]
            place, slack = self.rank - self.below, SLACK * self.rows / GRID_STEPS
            first = np.searchsorted(upto, place - slack) - 1
            last = np.searchsorted(upto, place + slack)
            self.candidates = (
                float(values[max(0, first)]),
                float(values[min(len(values) - 1, last)]),
            )


def _pass(df: DataFrame, targets: list[_Target]) -> list[dict]:
    """Measure all targets in one pass.

    Tasks report to a fixed number of groups, so that no single task merges the sketches of all
    others; each group draws its own grid, and the grids add up weighted by the group's rows.
    """
    named = [(i, name, c) for i, t in enumerate(targets) for name, c in t.measures().items()]
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    groups = df.groupBy(group).agg(*[c.alias(f"{name}_{i}") for i, name, c in named]).collect()
    results: list[dict] = [{} for _ in targets]
    for i, name, _ in named:
        if name != "grid":
            results[i][name] = sum(g[f"{name}_{i}"] for g in groups)
            continue
        drawn = [(g[f"grid_{i}"], g[f"rows_{i}"]) for g in groups if g[f"rows_{i}"]]
        values = np.concatenate([grid for grid, _ in drawn] or [[]])
        weights = np.concatenate([np.full(len(grid), n / len(grid)) for grid, n in drawn] or [[]])
        order = np.argsort(values)
        results[i]["grid"] = values[order], np.cumsum(weights[order])
    return results


def _finish(df: DataFrame, targets: list[_Target]) -> None:
    """Count the few values left around every target, in one pass, and pick by rank."""
    if not targets:
        return
    kept = []
    for i, target in enumerate(targets):
        values = present(F.col(quoted(target.column)))
        inner = F.when(target.inside(values), values).alias("value")
        kept.append(F.struct(F.lit(i).alias("i"), inner))
    counted = (
        df.select(F.inline(F.array(*kept)))
        .where(F.col("value").isNotNull())
        .groupBy("i", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    for i, target in enumerate(targets):
        seen = target.below
        for _, value, n in sorted(r for r in counted if r["i"] == i):
            seen += n
            if seen >= target.rank:
                target.value = value
                break


def exact_medians(
    df: DataFrame, columns: Sequence[str], midpoint: bool = False
) -> dict[str, float | None]:
    """Exact median of each column, ignoring missing values and NaN; None for an empty column.

    The lower median is a value of the column. With ``midpoint`` an even count gives the mean of
    the two middle values.

    Every pass is one aggregation: it counts around the last bounds and draws a quantile grid of
    what lies between them, which keeps about 1/250 of those rows. Bounds are exclusive, so a value
    that fills much of the column cannot stall the narrowing. Only counts, grids and the last
    ``FINAL_ROWS`` values of a rank reach the driver. The passes share a held copy of just these
    columns.
    """
    narrow = df.select(*[quoted(c) for c in columns]).persist()
    try:
        targets = []
        for c, found in zip(columns, _pass(narrow, [_Target(c) for c in columns])):
            n = found["rows"]
            ranks = [(n + 1) // 2] if n else []
            if n and midpoint and n % 2 == 0:
                ranks.append(n // 2 + 1)
            for rank in ranks:
                targets.append(_Target(c, rank))
                targets[-1].narrow(found)
        while wide := [t for t in targets if t.value is None and not t.countable]:
            for target, found in zip(wide, _pass(narrow, wide)):
                target.narrow(found)
        _finish(narrow, [t for t in targets if t.value is None])
    finally:
        narrow.unpersist()
    values = {c: [t.value for t in targets if t.column == c] for c in columns}
    return {c: sum(v) / len(v) if v else None for c, v in values.items()}
