"""Queries of the boosters and of all candidates fit them in the surveyed sizes."""

import pytest

from kvadrat import schema as S
from kvadrat.operators import modeling as M
from kvadrat.plans import registry

WHOLE = {
    "m11_gradient_boosting": ("gb_iter", 180),
    "m12_hist_gradient_boosting": ("hgb_iter", 160),
    "m13_catboost": ("cat_iter", 700),
    "m14_xgboost": ("xgb_iter", 500),
}


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", WHOLE)
def test_boosters_are_fitted_whole(spark, sf_dir, monkeypatch, name):
    def build(key, sizes, *rest):
        raise Asked(sizes)

    monkeypatch.setattr(M, "build_model_pipeline", build)
    with pytest.raises(Asked) as asked:
        registry.queries()[name](spark, sf_dir)
    field, rounds = WHOLE[name]
    assert getattr(asked.value.args[0], field) == rounds


def test_candidates_are_fitted_whole(spark, sf_dir, monkeypatch):
    def fit(train, specs, sizes, *rest):
        raise Asked(specs, sizes)

    monkeypatch.setattr(M, "fit_candidates", fit)
    with pytest.raises(Asked) as asked:
        registry.queries()["m17_train_candidates"](spark, sf_dir)
    specs, sizes = asked.value.args
    assert specs == S.DEFAULT_MODEL_CANDIDATES and sizes == M.Sizes()
