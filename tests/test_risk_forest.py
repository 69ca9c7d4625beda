import inspect

import pytest

from checks import catalog
from mishap.operators.forest import ForestParams
from mishap.plans import risk

FITTED = ["risk_predictions", "risk_metrics", "risk_support", "feature_importance", "feature_importance_names", "kpis"]


class Fitted(Exception):
    pass


@pytest.mark.parametrize("name", FITTED)
def test_queries_fit_the_default_forest(monkeypatch, name):
    signature = inspect.signature(risk.train_risk)

    def spy(*args, **named):
        bound = signature.bind(*args, **named)
        bound.apply_defaults()
        raise Fitted(bound.arguments["params"])

    monkeypatch.setattr(catalog, "staged_incidents", lambda spark, sf: None)
    monkeypatch.setattr(catalog.hotspots, "fit_hotspots", lambda df: None)
    monkeypatch.setattr(catalog.risk, "train_risk", spy)
    with pytest.raises(Fitted) as seen:
        catalog.QUERIES[name](None, "")
    assert seen.value.args[0] == ForestParams()
    assert (ForestParams().trees, ForestParams().max_depth) == (200, 10)
