import numpy as np
import pytest

from mishap.operators import quantiles
from mishap.operators.quantiles import exact_medians


def lower(values):
    kept = sorted(v for v in values if v is not None and v == v)
    return kept[(len(kept) - 1) // 2]


@pytest.mark.parametrize("size", [1, 2, 7, 5000])
def test_medians_match_sorting(spark, size):
    rng = np.random.default_rng(size)
    columns = {
        "spread": rng.normal(size=size),
        "tied": np.floor(rng.normal(size=size)),
        "tailed": np.exp(20 * rng.normal(size=size)),
        "hot": np.where(rng.random(size) < 0.4, 3.0, rng.normal(size=size)),
    }
    rows = [tuple(float(v) for v in row) for row in zip(*columns.values())]
    df = spark.createDataFrame(rows, list(columns)).repartition(3)
    got = exact_medians(df, list(columns))
    assert got == {c: lower(v) for c, v in columns.items()}
    middle = exact_medians(df, list(columns), midpoint=True)
    assert middle == pytest.approx({c: float(np.median(v)) for c, v in columns.items()})


@pytest.mark.parametrize("final", [5, 50])
def test_narrowing_passes(spark, monkeypatch, final):
    """With few values left to the last step, the answer comes from repeated narrowing."""
    monkeypatch.setattr(quantiles, "FINAL_ROWS", final)
    monkeypatch.setattr(quantiles, "GRID_STEPS", 20)
    rng = np.random.default_rng(final)
    columns = {
        "spread": rng.normal(size=4000),
        "hot": np.where(rng.random(4000) < 0.45, 3.0, rng.normal(size=4000) + 3),
        "edge": np.where(np.arange(4000) < 1999, rng.random(4000), 1.0),
    }
    rows = [tuple(float(v) for v in row) for row in zip(*columns.values())]
    df = spark.createDataFrame(rows, list(columns)).repartition(3)
    assert exact_medians(df, list(columns)) == {c: lower(v) for c, v in columns.items()}
    middle = exact_medians(df, list(columns), midpoint=True)
    assert middle == pytest.approx({c: float(np.median(v)) for c, v in columns.items()})


def test_empty_column_has_no_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan"))], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == {"a": None, "b": 1.0}
