import numpy as np
import pandas as pd
import pytest

from claimlake.operators import drift
from claimlake.operators.ranking import count_values, exact_quantiles
from claimlake.params import Params

PARAMS = Params()


def frame(spark, **columns):
    width = max(len(v) for v in columns.values())
    padded = {k: pd.Series(list(v) + [None] * (width - len(v)), dtype="float64") for k, v in columns.items()}
    table = spark.createDataFrame(pd.DataFrame(padded))
    from pyspark.sql import functions as F

    return table.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in table.columns])


def expected_psi(base, now, bins=10):
    edges = np.unique(np.percentile(base, np.linspace(0, 100, bins + 1)))
    if len(edges) < 2:
        return 0.0
    e = np.histogram(base, edges)[0] / len(base)
    a = np.histogram(now, edges)[0] / len(now)
    e, a = np.where(e == 0, 1e-6, e), np.where(a == 0, 1e-6, a)
    return round(float(np.sum((a - e) * np.log(a / e))), 4)


def report(spark, base, now, features=None):
    names = features or list(base)
    rows = drift.monitor_drift(frame(spark, **base), frame(spark, **now), PARAMS, names).collect()
    return {r["feature"]: r for r in rows}


def test_matches_numpy_on_several_shapes(spark):
    rng = np.random.default_rng(7)
    base = {
        "normal": rng.normal(0, 1, 900), "same": rng.normal(5, 2, 900), "counts": rng.poisson(2, 900) * 1.0,
        "skewed": rng.lognormal(3, 2, 900), "negative": -rng.lognormal(0, 3, 900), "near": 1000 + rng.random(900) / 1e6,
    }
    now = {
        "normal": rng.normal(2, 1, 700), "same": base["same"], "counts": rng.poisson(3, 700) * 1.0,
        "skewed": rng.lognormal(3.1, 2, 700), "negative": -rng.lognormal(0.2, 3, 700), "near": 1000 + rng.random(700) / 1e6,
    }
    rows = report(spark, base, now)
    for name in base:
        assert rows[name]["psi"] == pytest.approx(expected_psi(base[name], now[name]), abs=1e-4), name
    assert rows["same"]["psi"] == 0.0 and rows["normal"]["status"] == "CRITICAL"
    assert (rows["normal"]["n_baseline"], rows["normal"]["n_current"]) == (900, 700)


def test_degenerate_features_score_zero(spark):
    base = {"constant": [3.0] * 5, "empty": [None] * 5, "fine": [1.0, 2.0, 3.0, 4.0, 5.0]}
    now = {"constant": [9.0] * 5, "empty": [1.0] * 5, "fine": [None] * 5}
    rows = report(spark, base, now)
    assert {r["psi"] for r in rows.values()} == {0.0}
    assert (rows["empty"]["n_baseline"], rows["fine"]["n_current"]) == (0, 0)


def test_features_missing_on_a_side_are_skipped(spark):
    rows = report(spark, {"a": [1.0, 2.0], "b": [1.0, 2.0]}, {"a": [1.0, 2.0], "c": [1.0]}, ["a", "b", "c"])
    assert set(rows) == {"a"}


@pytest.mark.parametrize(
    "psi, status",
    [(0.05, "STABLE"), (0.10, "STABLE"), (0.101, "WARNING"), (0.15, "WARNING"), (0.25, "WARNING"), (0.251, "CRITICAL"), (0.30, "CRITICAL")],
)
def test_classification_is_strict(spark, psi, status):
    from pyspark.sql import functions as F

    assert spark.range(1).select(drift.classify(F.lit(psi), PARAMS)).first()[0] == status


def test_overall(spark):
    rows = [("a", 0.3, "CRITICAL", 1, 1), ("b", 0.0, "STABLE", 1, 1), ("c", 0.2, "WARNING", 1, 1)]
    df = spark.createDataFrame(rows, "feature string, psi double, status string, n_baseline long, n_current long")
    assert tuple(drift.report_overall(df).first()) == ("CRITICAL", 3, 2, 1, 0.3, "a,c")
    assert drift.report_overall(df.limit(0)).first()["overall_status"] == "STABLE"


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0, 1e3, 400), np.zeros(300), rng.random(50) * 1e-9, 2.0 ** np.arange(-20, 20), [-1e300, 1e300]])
    df = spark.createDataFrame(pd.DataFrame({"g": "x", "v": values}))
    probabilities = [0.0, 0.01, 0.25, 0.333, 0.5, 0.9, 1.0]
    got = exact_quantiles(count_values(df, ["g"], "v"), ["g"], "v", "n", probabilities).first()["quantiles"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_hot_value_does_not_change_the_answer(spark):
    values = np.concatenate([np.full(5000, 7.0), np.arange(2500.0)])
    df = spark.createDataFrame(pd.DataFrame({"g": "x", "v": values}))
    got = exact_quantiles(count_values(df, ["g"], "v"), ["g"], "v", "n", [0.1, 0.5, 0.95]).first()["quantiles"]
    assert got == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.95])))


def test_buckets_keep_the_order_and_bound_their_size(spark):
    from pyspark.sql import functions as F

    from claimlake.operators.ranking import value_buckets

    rng = np.random.default_rng(5)
    powers = 2.0 ** np.arange(-60, 60)
    near = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf)])
    tight = 1.0 + np.arange(3000) * 2.0**-50
    values = np.unique(np.concatenate([near, -near, tight, -tight, [0.0, 5e-324, -5e-324], rng.normal(0, 1, 2000)]))
    coarse, fine = value_buckets(F.col("v"))
    table = spark.createDataFrame(pd.DataFrame({"v": values})).select("v", coarse.alias("c"), fine.alias("f")).toPandas()
    table = table.sort_values("v")
    numbers = list(zip(table["c"], table["f"]))
    assert numbers == sorted(numbers)


def test_values_packed_into_one_coarse_bucket(spark):
    values = 1.0 + np.random.default_rng(9).permutation(20_000) * 2.0**-40
    df = spark.createDataFrame(pd.DataFrame({"g": "x", "v": values}))
    got = exact_quantiles(count_values(df, ["g"], "v"), ["g"], "v", "n", [0.0, 0.3, 0.77, 1.0]).first()["quantiles"]
    assert got == list(np.quantile(values, [0.0, 0.3, 0.77, 1.0])) or got == pytest.approx(
        list(np.quantile(values, [0.0, 0.3, 0.77, 1.0])), rel=1e-15
    )
