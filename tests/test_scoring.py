import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimlake.codes import FEATURES, LEAK_FREE_FEATURES
from claimlake.operators import modeling, scoring
from claimlake.params import Params

CLASSES = ("high", "low", "moderate")


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(11)
    n = 600
    actual = rng.choice(CLASSES, n, p=[0.3, 0.1, 0.6])
    scores = rng.random((n, 3)).round(2)  # two digits, so scores tie
    scores[np.arange(n), [CLASSES.index(a) for a in actual]] += 0.3
    table = pd.DataFrame(scores, columns=[f"prob_{c}" for c in CLASSES])
    table["risk_tier"] = actual
    table["predicted_tier"] = [CLASSES[i] for i in scores.argmax(axis=1)]
    table["confidence"] = np.minimum(scores.max(axis=1), 1.0)
    table["estimated_annual_cost"] = rng.lognormal(9, 1, n)
    table["predicted_cost"] = table["estimated_annual_cost"] * rng.normal(1, 0.2, n)
    return table, spark.createDataFrame(table)


def pairwise_auc(pos, neg):
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_against_all_pairs(predictions):
    table, df = predictions
    got = {r["class"]: r["auc"] for r in scoring.auc_one_vs_rest(df, CLASSES).collect()}
    for c in CLASSES:
        mine = (table["risk_tier"] == c).to_numpy()
        scores = table[f"prob_{c}"].to_numpy()
        assert got[c] == pytest.approx(pairwise_auc(scores[mine], scores[~mine]), abs=1e-6)
    assert scoring.macro_auc(df, CLASSES).first()[0] == pytest.approx(np.mean(list(got.values())), abs=1e-4)


def test_auc_is_null_without_both_sides(predictions):
    _, df = predictions
    only = df.filter("risk_tier = 'high'")
    assert {r["auc"] for r in scoring.auc_one_vs_rest(only, CLASSES).collect()} == {None}
    assert scoring.macro_auc(only, CLASSES).first()[0] is None


def test_class_report(predictions):
    table, df = predictions
    rows = {r["label"]: r for r in scoring.class_report(df).collect()}
    f1s = []
    for c in CLASSES:
        hits = ((table.risk_tier == c) & (table.predicted_tier == c)).sum()
        precision, recall = hits / (table.predicted_tier == c).sum(), hits / (table.risk_tier == c).sum()
        assert rows[c]["precision"] == pytest.approx(precision, abs=1e-6)
        assert rows[c]["recall"] == pytest.approx(recall, abs=1e-6)
        f1s.append(2 * precision * recall / (precision + recall))
        assert rows[c]["f1_score"] == pytest.approx(f1s[-1], abs=1e-6)
    assert rows["macro avg"]["f1_score"] == pytest.approx(np.mean(f1s), abs=1e-6)
    assert rows["weighted avg"]["recall"] == pytest.approx((table.risk_tier == table.predicted_tier).mean(), abs=1e-6)
    assert rows["weighted avg"]["support"] == len(table)


def test_class_never_predicted_has_zero_precision(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b")], "risk_tier string, predicted_tier string")
    rows = {r["label"]: r for r in scoring.class_report(df).collect()}
    assert rows["a"]["precision"] == rows["a"]["recall"] == rows["a"]["f1_score"] == 0.0
    assert rows["b"]["precision"] == 0.5 and rows["b"]["recall"] == 1.0


def test_accuracy_confusion_regression(predictions):
    table, df = predictions
    hit = (table.risk_tier == table.predicted_tier).mean()
    assert scoring.accuracy(df).first()["tier_accuracy"] == round(hit, 4)
    assert sum(r["n"] for r in scoring.confusion(df).collect()) == len(table)
    y, p = table.estimated_annual_cost, table.predicted_cost
    row = scoring.regression_metrics(df).first()
    assert row["cost_mae"] == pytest.approx((y - p).abs().mean(), abs=0.01)
    assert row["cost_rmse"] == pytest.approx(math.sqrt(((y - p) ** 2).mean()), abs=0.01)
    assert row["cost_r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-4)


def test_calibration_error(predictions):
    table, df = predictions
    bins = np.minimum((table.confidence * 10).astype(int), 9)
    hit = (table.risk_tier == table.predicted_tier).astype(float)
    want = sum(
        (bins == b).sum() * abs(hit[bins == b].mean() - table.confidence[bins == b].mean()) for b in set(bins)
    ) / len(table)
    assert scoring.expected_calibration_error(df).first()["ece"] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("sizes", [{"high": 1, "low": 2, "moderate": 1007}, {"low": 35}])
def test_split_against_sorting(spark, sizes):
    rows = [(f"{tier}{i}", tier) for tier, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "bene_id string, risk_tier string")
    got = {r["bene_id"] for r in modeling.stratified_split(df, Params()).filter("is_train").collect()}
    want = set()
    for tier, n in sizes.items():
        ordered = sorted((k for k, t in rows if t == tier), key=lambda k: hashlib.md5(k.encode()).hexdigest())
        want |= set(ordered[: n - math.ceil(n * 0.2)])
    assert got == want


def test_labels_are_alphabetical(predictions):
    _, df = predictions
    assert {r["risk_tier"]: r["label_index"] for r in modeling.label_index(df).collect()} == {c: i for i, c in enumerate(CLASSES)}


def test_missing_features_are_named(spark):
    with pytest.raises(ValueError, match="sex_male"):
        modeling.feature_matrix(spark.createDataFrame([("A", 70)], "bene_id string, age int"))


def store(spark, n=400):
    raw = spark.range(n).select(
        F.concat(F.lit("BNE"), F.col("id")).alias("bene_id"),
        *[((F.xxhash64("id", F.lit(f)) % 1000) / 10.0).alias(f) for f in FEATURES],
    )
    signal = F.col("age") + F.col("pre_pmpm")
    return raw.withColumns(
        {
            "risk_tier": F.when(signal > 60, "high").when(signal > -20, "moderate").otherwise("low"),
            "estimated_annual_cost": signal * 10 + 5000,
        }
    )


@pytest.mark.parametrize("learner", ["forest", "boosted"])
def test_model_learns_and_calibrates(spark, learner):
    params = Params(n_trees=8, max_depth=4, learning_rate=0.3, calibration_folds=2)
    model = modeling.RiskModel(params, LEAK_FREE_FEATURES, learner)
    with pytest.raises(RuntimeError):
        model.predict(store(spark))
    split = modeling.stratified_split(store(spark), params)
    model.fit(split.filter("is_train"))
    out = model.predict(split.filter("NOT is_train"))
    probabilities = [F.col(f"prob_{c}") for c in model.classes]
    assert out.filter(F.abs(sum(probabilities[1:], probabilities[0]) - 1) > 1e-9).count() == 0
    assert scoring.accuracy(out).first()["tier_accuracy"] > 0.6
    assert scoring.regression_metrics(out).first()["cost_r2"] > 0.2
    top = model.importance(5).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert {"age", "pre_pmpm"} <= {r["feature"] for r in top}
