import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake.codes import CONDITIONS
from claimlake.operators import features, rollups
from claimlake.params import Params
from claimlake.plans import gold, views

PARAMS = Params(cutover_year=1998)


def mapped(spark, rows):
    """rows: bene, date, amount, raf, interaction, hcc_list, inpatient."""
    df = spark.createDataFrame(
        rows, "bene_id string, d string, claim_amount double, hcc_raf_total double, hcc_interaction_total double, hcc_list array<int>, is_inpatient boolean"
    ).withColumn("service_date", F.to_date("d"))
    year = F.year("service_date")
    flags = {flag: F.array_contains("hcc_list", numbers[0]) for flag, numbers in CONDITIONS.items()}
    return df.withColumns(
        {
            "claim_id": F.monotonically_increasing_id().cast("string"),
            "service_year": year,
            "service_month": F.month("service_date"),
            "period": F.when(year >= 1998, "post").otherwise("pre"),
            "hcc_burden_count": F.size("hcc_list"),
            "is_ed_visit": F.lit(False), "is_specialist": F.lit(False), "is_primary_care": F.lit(True),
            "allowed_amount": F.col("claim_amount"), "paid_amount": F.col("claim_amount"),
            "intervention_arm": F.lit(1), "_quality_pass": F.lit(True),
            **flags,
        }
    )


def profile(spark, *ids):
    return spark.createDataFrame([(i, 0.5) for i in ids], "bene_id string, demographic_raf double")


@pytest.fixture(scope="module")
def claims(spark):
    return mapped(
        spark,
        [
            ("A", "1996-03-01", 100.0, 0.323, 0.0, [85], True),
            ("A", "1997-03-01", 50.0, 0.421, 0.0, [96], False),
            ("A", "1997-03-09", 30.0, 0.744, 0.175, [85, 96], False),
            ("A", "1999-05-01", 200.0, 0.1, 0.0, [], False),
            ("B", "1999-05-01", 10.0, 2.5, 0.0, [8], True),
        ],
    )


def test_score_uses_largest_claim_not_sum(spark, claims):
    rows = {r["bene_id"]: r for r in gold.member_raf_scores(profile(spark, "A", "B", "N"), claims, PARAMS).collect()}
    a, b, nobody = rows["A"], rows["B"], rows["N"]
    assert a["raf_score"] == pytest.approx(0.5 + 0.744 + 0.175) and a["risk_tier"] == "moderate"
    assert b["risk_tier"] == "high" and b["estimated_annual_cost"] == pytest.approx(3.0 * 9800)
    assert (a["pre_months"], a["post_months"]) == (2, 1)  # March of two years counts twice
    assert a["pre_total_cost"] == 180.0 and a["pre_pmpm"] == 90.0 and a["post_pmpm"] == 200.0
    assert a["actual_pmpm"] == pytest.approx(380 / 3) and a["total_claims"] == 4 and a["ip_admit_count"] == 1
    assert nobody["raf_score"] == 0.5 and nobody["actual_pmpm"] == 0.0 and nobody["risk_tier"] == "low"
    assert nobody["pre_pmpm"] is None and nobody["has_chf"] is None and nobody["total_claims"] == 0


def test_tier_boundaries(spark):
    from claimlake.functions.expressions import risk_tier

    df = spark.createDataFrame([(1.1999,), (1.2,), (1.9999,), (2.0,)], "s double")
    assert [r[0] for r in df.select(risk_tier(F.col("s"), PARAMS)).collect()] == ["low", "moderate", "moderate", "high"]


def test_union_score_counts_each_category_once(spark, claims):
    rows = {r["bene_id"]: r for r in rollups.member_union_scores(profile(spark, "A", "N"), claims).collect()}
    assert rows["A"]["hcc_list"] == [85, 96]
    assert rows["A"]["raf_score_member_union"] == pytest.approx(0.5 + 0.744 + 0.175)
    assert rows["N"]["hcc_list"] == [] and rows["N"]["raf_score_member_union"] == 0.5


def test_utilization(spark, claims):
    rows = {(r["bene_id"], r["period"]): r for r in rollups.utilization(claims).collect()}
    a = rows["A", "pre"]
    assert (a["service_days"], a["n_months"], a["total_claims"], a["ip_admits"]) == (3, 2, 3, 1)
    assert a["pmpm_cost"] == 90.0 and a["ip_rate_per_1000"] == pytest.approx(1000 / 2 / 12)
    assert a["primary_care_visits"] == 3


def test_rolling_mean_spans_rows(spark):
    rows = [("A", d, v, 0.0, 0.0, [], False) for d, v in
            [("1997-01-01", 1.0), ("1997-02-01", 2.0), ("1997-11-01", 6.0), ("1998-01-01", 10.0)]]
    out = rollups.monthly_trends(mapped(spark, rows), PARAMS).collect()
    assert [r["pmpm_rolling_3m"] for r in out] == [1.0, 1.5, 3.0, 6.0]
    assert [r["period"] for r in out] == ["pre", "pre", "pre", "post"]


def test_effect_needs_all_four_cells(spark):
    cells = [("pre", 0, 10.0), ("post", 0, 12.0), ("pre", 1, 10.0), ("post", 1, 9.0)]
    frame = lambda rows: spark.createDataFrame(rows, "period string, intervention_arm int, pmpm_cost double")
    row = rollups.did_estimate(frame(cells)).first()
    assert row["att_pmpm"] == -3.0 and row["att_annual"] == -36.0
    assert rollups.did_estimate(frame(cells[:3])).first()["att_pmpm"] is None


def test_feature_store_shape_and_filling(spark, claims):
    people = profile(spark, "A", "N").withColumns(
        {"age": F.lit(70), "age_bracket": F.lit(70), "sex": F.when(F.col("bene_id") == "A", "M"),
         "dual_eligible": F.lit(0), "state": F.lit("X"), "intervention_arm": F.lit(1)}
    )
    scores = gold.member_raf_scores(people, claims, PARAMS)
    store = gold.risk_feature_store(scores, claims)
    assert len(store.columns) == 1 + 33 + 4
    rows = {r["bene_id"]: r for r in store.collect()}
    a, nobody = rows["A"], rows["N"]
    assert a["pre_total_cost"] == 180.0 and a["pre_avg_claim"] == 60.0 and a["pre_max_claim"] == 100.0
    assert a["pre_n_months"] == 2 and a["pre_ip_rate"] == 0.5 and a["has_chf"] == 1 and a["sex_male"] == 1
    assert nobody["has_chf"] == 0 and nobody["pre_pmpm"] == 0.0 and nobody["log_pre_pmpm"] == 0.0
    assert nobody["sex_male"] is None


def test_reports_show_no_member_ids(spark, claims):
    scores = gold.member_raf_scores(profile(spark, "A", "B"), claims, PARAMS)
    scores.createOrReplaceTempView("t_scores")
    claims.withColumns({"primary_hcc": F.lit(85), "primary_hcc_desc": F.lit("Congestive Heart Failure")}).createOrReplaceTempView("t_mapped")
    rollups.monthly_trends(claims, PARAMS).createOrReplaceTempView("t_trends")
    names = views.create_views(
        spark, {"scores": "t_scores", "trends": "t_trends", "mapped": "t_mapped"}, prefix="x_", temporary=True
    )
    assert len(names) == 5
    for name in names:
        assert "bene_id" not in spark.table(name).columns
        assert spark.table(name).count() > 0
    share = spark.table("x_v_high_risk_share").agg(F.sum("pct_of_population")).first()[0]
    assert share == pytest.approx(100.0, abs=0.2)


def test_broken_view_raises(spark):
    with pytest.raises(Exception):
        views.create_views(spark, {"scores": "no_such", "trends": "no_such", "mapped": "no_such"}, temporary=True)
