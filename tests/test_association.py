"""Trends, co-occurrence, correlations, attribution and permutation importance against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.operators import association, explain, modeling
from claimlake.params import Params
from claimlake.sources.fixtures import FIXTURE_PARAMS
from claimlake.plans import catalog


def trend_rows(spark, rows):
    columns = "service_year int, service_month int, intervention_arm int, period string, pmpm_cost double"
    return spark.createDataFrame(rows, columns)


def test_parallel_trends_by_the_normal_equations(spark):
    rng = random.Random(8)
    rows = [
        (2020 + m // 12, 1 + m % 12, arm, "pre", 100 + 2.0 * m + arm * (5 + 0.7 * m) + rng.gauss(0, 3))
        for m in range(24) for arm in (0, 1) if (m, arm) != (3, 1)
    ]
    rows += [(2022, 1, 1, "post", 900.0)]
    got = association.parallel_trends(trend_rows(spark, rows)).first()
    x = np.array([[1, y * 12 + m, a, a * (y * 12 + m)] for y, m, a, p, _ in rows if p == "pre"], float)
    y = np.array([v for *_, p, v in rows if p == "pre"])
    x[:, 1] -= 2020 * 12
    x[:, 3] -= x[:, 2] * 2020 * 12
    beta, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    error = math.sqrt(rss[0] / (len(y) - 4) * np.linalg.inv(x.T @ x)[3, 3])
    assert got.interaction == pytest.approx(beta[3]) and got.standard_error == pytest.approx(error)
    assert got.t_value == pytest.approx(beta[3] / error) and got.degrees_of_freedom == len(y) - 4


def test_parallel_trends_without_enough_months(spark):
    one = association.parallel_trends(trend_rows(spark, [(2020, 1, 0, "pre", 1.0), (2020, 1, 1, "pre", 2.0)])).first()
    assert one.interaction is None and one.t_value is None
    none = association.parallel_trends(trend_rows(spark, [])).first()
    assert none.n_control == 0 and none.standard_error is None


def test_event_study_reference_is_the_last_month_with_both_arms(spark):
    rows = [(2020, 10, 0, "pre", 10.0), (2020, 10, 1, "pre", 13.0), (2020, 11, 1, "pre", 99.0), (2021, 1, 0, "post", 5.0), (2021, 1, 1, "post", 6.0)]
    got = {(r.service_year, r.service_month): r for r in association.event_study(trend_rows(spark, rows)).collect()}
    assert got[2020, 10].effect == 0 and got[2020, 11].effect is None
    assert (got[2021, 1].event_month, got[2021, 1].effect, got[2020, 10].event_month) == (0, -2.0, -3)


def test_co_occurrence_by_counting(spark):
    rng = random.Random(3)
    lines = [(f"m{rng.randrange(60)}", rng.sample([8, 9, 85, 96, 111], rng.randrange(4))) for _ in range(300)] + [("m0", None), ("m99", [])]
    got = association.co_occurrence(spark.createDataFrame(lines, "bene_id string, hcc_list array<int>"), min_support=0.4).collect()
    owned = {}
    for member, items in lines:
        owned.setdefault(member, set()).update(items or [])
    for r in got:
        both = sum({r.item_a, r.item_b} <= s for s in owned.values())
        n_a, n_b = (sum(i in s for s in owned.values()) for i in (r.item_a, r.item_b))
        assert (r.n_both, r.n_a, r.n_b) == (both, n_a, n_b) and r.item_a < r.item_b
        assert r.lift == pytest.approx(both * len(owned) / (n_a * n_b)) and r.support >= 0.4
    assert got


def test_correlations(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(200, 3)) + 1e6
    rows = [(float(a), float(a + b - 1e6), float(c), 1.0) for a, b, c in base]
    got = {(r.feature_a, r.feature_b): r.correlation for r in association.correlations(spark.createDataFrame(rows, "a double, b double, c double, d double"), ["a", "b", "c", "d"]).collect()}
    want = np.corrcoef(np.array(rows)[:, :3].T)
    assert got["a", "b"] == pytest.approx(want[0, 1], abs=1e-6) and got["b", "c"] == pytest.approx(want[1, 2], abs=1e-6)
    assert got["a", "d"] is None and len(got) == 6


def test_correlations_take_one_aggregate(spark, sf_dir):
    lake = catalog.Lake(spark, sf_dir)
    matrix = modeling.feature_matrix(lake.store())
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    aggregates = lambda df: plan(df).count("Aggregate [")
    assert aggregates(association.correlations(matrix, ("age", "raf_score", "pre_pmpm"))) == aggregates(matrix) + 1


@pytest.mark.parametrize("digits", [0, 2])
def test_exchange_keeps_every_column(spark, digits):
    rows = [(f"k{i}", float(i), float(-i)) for i in range(300)]
    swapped = explain.exchanged(spark.createDataFrame(rows, "k string, x double, y double"), ["x", "y"], "k", digits).collect()
    for feature, column in (("x", 1), ("y", 2)):
        values = {r.k: r.value for r in swapped if r.feature == feature}
        assert sorted(values.values()) == sorted(r[column] for r in rows)
        assert sum(values[r[0]] != r[column] for r in rows) > (290 if digits == 0 else 60)


@pytest.mark.parametrize("learner, tolerance", [("forest", 1e-9), ("boosted", 1e-9)])
def test_contributions_add_up(spark, sf_dir, learner, tolerance):
    """Bias and contributions against the ensembles' own raw scores."""
    from pyspark.ml.functions import vector_to_array

    store = catalog.Lake(spark, sf_dir).store().cache()
    params = Params(n_trees=4, max_depth=3)
    model = modeling.RiskModel(params, learner=learner).fit(store, calibrate=False)
    parts = model.attribution(store).groupBy("bene_id", "output").agg(F.sum("contribution").alias("total"))
    totals = {(r.bene_id, r.output): r.total for r in parts.collect()}
    matrix = model._assemble(store)
    wanted = {(r.bene_id, modeling.COST): r.v for r in model.regressor.transform(matrix).select("bene_id", F.col("predicted_cost").alias("v")).collect()}
    for c, scorer in zip(model.classes, model.scorer.models):
        raw = vector_to_array("rawPrediction")
        for r in scorer.transform(matrix).select("bene_id", raw.alias("raw")).collect():
            if learner == "forest":
                wanted |= {(r.bene_id, name): v / params.n_trees for name, v in zip(model.classes, r.raw)}
            else:
                wanted[r.bene_id, c] = r.raw[1]
    assert set(totals) == set(wanted)
    assert all(totals[k] == pytest.approx(v, rel=tolerance, abs=tolerance) for k, v in wanted.items())
    top = explain.leading_features(model.attribution(store), "bene_id", 2)
    assert top.where("rank > 2").count() == 0 and top.where(F.col("feature") == explain.BIAS).count() == 0
    store.unpersist()


def test_unused_features_have_no_importance(spark, sf_dir):
    rows = catalog.registered()["ml_permutation_importance"](spark, sf_dir).collect()
    used = {"demographic_raf", "max_hcc_raf", "max_interaction_raf", "pre_ed_visits"}
    assert len(rows) == 33 and all(r.importance == 0 for r in rows if r.feature not in used)
    assert max(rows, key=lambda r: r.importance).feature in used
    assert FIXTURE_PARAMS.n_trees == 300
