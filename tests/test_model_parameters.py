"""The registered model queries train the models that the parameters describe."""

import pytest

from claimlake import Params
from claimlake.plans import catalog


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["ml_predictions", "ml_evaluation", "ml_importance"])
def test_forests_have_the_size_of_the_parameters(spark, sf_dir, monkeypatch, name):
    def asked(params, **_):
        raise Asked(params)

    monkeypatch.setattr(catalog.modeling, "RiskModel", asked)
    with pytest.raises(Asked) as found:
        catalog.registered()[name](spark, sf_dir)
    params = found.value.args[0]
    assert (params.n_trees, params.max_depth) == (Params().n_trees, Params().max_depth)
