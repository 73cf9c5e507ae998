"""Registered model queries train at full size on the whole embedding."""

import pytest

from cellframe.operators import models
from cellframe.plans import scores


class Fitted(Exception):
    pass


def test_sizes(spark, sf, monkeypatch):
    seen = {}

    def fit(df, features, label, classifier):
        raise Fitted(len(features), classifier)

    monkeypatch.setattr(models, "fit", fit)
    for name in ("rf_score", "feature_importance", "gbt_score"):
        with pytest.raises(Fitted) as e:
            scores.QUERIES[name](spark, sf)
        seen[name] = e.value.args
    assert all(seen[n][0] == 64 for n in seen)
    assert seen["rf_score"][1].getNumTrees() == seen["feature_importance"][1].getNumTrees() == 400
    assert seen["gbt_score"][1].getMaxIter() == 1000

    made = []
    monkeypatch.setattr(models, "cross_validated", lambda df, features, label, fold, make, folds: made.append((len(features), make())) or [0.5] * folds)
    scores.QUERIES["model_select"](spark, sf)
    sizes = {type(c).__name__: (n, c) for n, c in made}
    assert all(n == 64 for n, _ in made)
    assert sizes["RandomForestClassifier"][1].getNumTrees() == 400 and sizes["GBTClassifier"][1].getMaxIter() == 100
