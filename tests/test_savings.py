import pytest
from pyspark.sql import functions as F

from claimlake.operators import savings
from claimlake.params import Params

PARAMS = Params()


def one(spark, benchmark, actual, lives, **extra):
    df = savings.scenario_frame(spark, [(float(benchmark), float(actual), lives)])
    df = df.withColumns({k: F.lit(v) for k, v in extra.items()})
    return savings.with_savings(df, PARAMS).first()


def test_below_minimum_rate(spark):
    row = one(spark, 1000, 995, 10_000)
    assert row["status"] == "BELOW_MSR" and row["earned_savings"] == 0.0 and not row["exceeds_msr"]


def test_above_minimum_rate(spark):
    row = one(spark, 1000, 960, 10_000)
    assert row["savings_rate"] == pytest.approx(0.04) and row["status"] == "SAVINGS_EARNED"
    assert row["earned_savings"] == pytest.approx(row["gross_savings"] * 0.5)


def test_exactly_at_minimum_rate_earns_nothing(spark):
    assert one(spark, 1000, 750, 10, msr=0.25)["status"] == "BELOW_MSR"


def test_gross_and_per_member(spark):
    row = one(spark, 1000, 950, 10_000)
    assert row["gross_savings"] == 6_000_000 and row["per_member_gross"] == 600


def test_loss_and_empty_cohort(spark):
    assert one(spark, 816.67, 900, 10_000)["gross_savings"] < 0
    empty = one(spark, 1000, 900, 0)
    assert empty["gross_savings"] == 0 and empty["per_member_gross"] == 0 and empty["savings_rate"] == 0


def att(spark, value, lives):
    df = spark.createDataFrame([(float(value), lives)], "att_annual_savings double, n_lives int")
    return savings.savings_from_att(df, PARAMS).first()


def test_from_effect(spark):
    assert att(spark, 391, 10_000)["exceeds_msr"]
    assert att(spark, 120, 1000)["gross_savings"] == pytest.approx(120_000)


def test_projection_scales_with_population(spark):
    df = spark.createDataFrame([(391.0,)], "att_annual_savings double")
    rows = savings.project(df, PARAMS).orderBy("n_lives").collect()
    assert [r["n_lives"] for r in rows] == [10_000, 100_000, 500_000, 1_000_000, 4_700_000]
    assert rows[1]["gross_savings"] == pytest.approx(10 * rows[0]["gross_savings"])


def test_override_grid(spark):
    df = savings.scenario_frame(spark, [(1000.0, 960.0, 10_000)])
    rows = savings.override_grid(df, [0.3, 0.7], [0.02, 0.05], PARAMS).collect()
    earned = {(r["sharing_rate"], r["msr"]): r["earned_savings"] for r in rows}
    assert earned[0.7, 0.02] == pytest.approx(earned[0.3, 0.02] * 7 / 3)
    assert earned[0.3, 0.05] == earned[0.7, 0.05] == 0.0


def test_from_scores_by_cohort_and_override(spark):
    scores = spark.createDataFrame([("A", "X", 100.0), ("B", "X", 300.0), ("C", "Y", 900.0)], "bene_id string, state string, actual_pmpm double")
    rows = {r["state"]: r for r in savings.savings_from_scores(scores, PARAMS, by=["state"]).collect()}
    assert rows["X"]["actual_pmpm"] == 200.0 and rows["X"]["n_lives"] == 2
    assert savings.savings_from_scores(scores, PARAMS, n_lives=7).first()["n_lives"] == 7
    assert savings.savings_from_scores(scores.limit(0), PARAMS).first()["actual_pmpm"] == 0.0
