"""Values of fitted models: predictions of members against their tiers and costs, and learners side by side."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from claimlake import Params
from claimlake.codes import FEATURES
from claimlake.operators import modeling, scoring
from claimlake.plans import catalog
from claimlake.sources.fixtures import FIXTURE_PARAMS

SMALL = dataclasses.replace(FIXTURE_PARAMS, n_trees=24)


@pytest.fixture(scope="module")
def predicted(spark):
    """Test members of sf0.01 by a forest over all features, with a fixed seed."""
    train, test = catalog._split_store(catalog.Lake(spark, "/root/testdata/sf0.01"))
    frame = modeling.RiskModel(SMALL, features=FEATURES).fit(train, calibrate=False).predict(test).cache()
    yield frame
    frame.unpersist()


def test_predictions_follow_tiers_and_costs(predicted):
    """The features tell tier and cost nearly outright, so a right model is nearly right."""
    accuracy = scoring.accuracy(predicted).first().tier_accuracy
    tiers = [r["count"] for r in predicted.groupBy("risk_tier").count().collect()]
    assert accuracy > 0.9 > max(tiers) / sum(tiers)
    errors = scoring.regression_metrics(predicted).first()
    assert errors.cost_r2 > 0.9 and errors.cost_mae < errors.cost_rmse
    assert scoring.macro_auc(predicted, catalog.CLASSES).first().auc_macro > 0.95


def test_predicted_rows(predicted):
    rows = predicted.collect()
    assert {r.predicted_tier for r in rows} <= set(catalog.CLASSES) and len({r.bene_id for r in rows}) == len(rows)
    for r in rows:
        shares = [r[f"prob_{c}"] for c in catalog.CLASSES]
        assert sum(shares) == pytest.approx(1) and r.confidence == max(shares) == r[f"prob_{r.predicted_tier}"]


def test_registered_predictions_return_every_test_member(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog.modeling, "RiskModel", lambda params: modeling_model(dataclasses.replace(params, n_trees=3)))
    got = catalog.registered()["ml_member_predictions"](spark, sf_dir)
    wanted = catalog._split_store(catalog.Lake(spark, sf_dir))[1].select("bene_id")
    assert {"predicted_tier", "predicted_cost", "confidence", *[f"prob_{c}" for c in catalog.CLASSES]} <= set(got.columns)
    assert sorted(r.bene_id for r in got.collect()) == sorted(r.bene_id for r in wanted.collect())


modeling_model = modeling.RiskModel


def test_learners_fit_side_by_side(spark):
    squares = modeling.side_by_side([lambda i=i: spark.range(i + 1).agg(F.sum(F.col("id") * F.col("id"))).first()[0] for i in range(4)])
    assert squares == [0, 1, 5, 14]
    with pytest.raises(ZeroDivisionError):
        modeling.side_by_side([lambda: 1, lambda: 1 // 0])
    assert Params().n_trees == 300
