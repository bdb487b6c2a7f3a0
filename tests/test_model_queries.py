import inspect

import pytest

from rentlens.models import regression as R
from rentlens.queries import QUERIES, modelling

SF = "/root/testdata/sf0.001"


class Called(Exception):
    pass


@pytest.mark.parametrize(
    ("name", "module", "operator"),
    [
        ("predict_matrix", R, "fit_ensemble"), ("predict_mean", R, "fit_ensemble"), ("permutation_importance", R, "fit_ensemble"),
        ("stability_selection", R, "stability_selection"), ("k_curve", R, "k_curve"), ("repeat_over_seeds", R, "repeat_over_seeds"),
        ("surface_regression_impute", R, "surface_regression_impute"), ("apply_saved_imputer", R, "fit_surface_imputer"),
        ("train_production", modelling, "train_production"), ("param_search", R, "param_search"),
    ],
)
def test_queries_run_the_operators_own_sizes(spark, monkeypatch, name, module, operator):
    """Fits, folds, trees and parameters are the operator's defaults; the draws of ``param_search`` are as many as its SQL lists."""
    signature = inspect.signature(getattr(module, operator))

    def instead(*args, **named):
        raise Called(signature.bind(*args, **named).arguments)

    monkeypatch.setattr(module, operator, instead)
    with pytest.raises(Called) as found:
        QUERIES[name](spark, SF)
    given = found.value.args[0]
    sizes = {"n_models", "params", "folds", "n_seeds", "k_min", "k_max", "trees"}
    assert {k: v for k, v in given.items() if k in sizes and v != signature.parameters[k].default} == {}
