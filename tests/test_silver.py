import datetime as dt

from pyspark.sql import functions as F

from claimlake.functions import expressions as X
from claimlake.operators import claims as C
from claimlake.operators import members, validation
from claimlake.params import Params
from claimlake.plans import silver
from claimlake.sources import schemas

PARAMS = Params(cutover_year=1998, as_of=dt.date(2001, 6, 30))


def claim(spark, *rows):
    base = {
        "claim_id": "C1", "bene_id": "B1", "service_date": "1999-03-06", "claim_year": 1999, "claim_month": 3,
        "service_type": "ip_admit", "icd10_primary": "I500", "icd10_codes": "I500", "provider_specialty": "01",
        "claim_amount": 100.0, "allowed_amount": 90.0, "paid_amount": 80.0, "plan_type": "HMO", "intervention_arm": 1,
    }
    schema = schemas.with_corrupt(schemas.CLAIMS)
    full = [tuple({**base, **r}.get(n) for n in schema.names) for r in rows]
    return spark.createDataFrame(full, schema).drop(schemas.CORRUPT)


def test_unreadable_values_become_null(spark):
    raw = claim(spark, {}, {"service_date": "bad-date"}, {"service_date": "1999-3-6"}, {"service_date": "1999-02-30"})
    raw = raw.withColumn("claim_amount", F.lit("x"))
    rows = C.cast_claims(raw).collect()
    assert [r["service_date"] for r in rows] == [dt.date(1999, 3, 6), None, None, None]
    assert [r["claim_amount"] for r in rows] == [None] * 4
    assert [r["claim_year"] for r in rows] == [1999, None, None, None]


def test_given_month_wins_when_asked(spark):
    raw = claim(spark, {"claim_year": 2005, "claim_month": None})
    row = C.cast_claims(raw, keep_given_month=True).first()
    assert (row["claim_year"], row["claim_month"]) == (2005, 3)


def test_dedup_keeps_highest_paid_and_null_loses(spark):
    raw = claim(spark, {"paid_amount": 10.0}, {"paid_amount": 30.0}, {"paid_amount": None}, {"claim_id": "C2", "paid_amount": None})
    kept = C.dedup_keep_best(raw, PARAMS.dedup_keys)
    assert {(r["claim_id"], r["paid_amount"]) for r in kept.collect()} == {("C1", 30.0), ("C2", None)}


def test_null_keys_form_one_group(spark):
    raw = claim(spark, *[{"claim_id": None, "paid_amount": float(i)} for i in range(5)])
    assert [r["paid_amount"] for r in C.dedup_keep_best(raw, PARAMS.dedup_keys).collect()] == [4.0]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [{"claim_amount": a, "icd10_codes": c} for a in (1.0, 2.0) for c in ("A", "B", "C")]
    for order in (rows, rows[::-1]):
        kept = C.dedup_keep_best(claim(spark, *order), PARAMS.dedup_keys).collect()
        assert [(r["claim_amount"], r["icd10_codes"]) for r in kept] == [(2.0, "C")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    raw = claim(spark, {}).crossJoin(spark.range(0, 5000, numPartitions=8)).withColumn("paid_amount", F.col("id") * 1.0)
    kept = C.dedup_keep_best(raw.drop("id"), PARAMS.dedup_keys)
    assert [r["paid_amount"] for r in kept.collect()] == [4999.0]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_nine_flags_and_three_valued_pass(spark):
    cases = {
        "flag_null_claim_id": {"claim_id": None},
        "flag_null_bene_id": {"bene_id": None},
        "flag_negative_amount": {"claim_id": "n", "claim_amount": -1.0},
        "flag_zero_amount": {"claim_id": "z", "claim_amount": 0.0},
        "flag_excessive_amount": {"claim_id": "x", "claim_amount": 500_000.01},
        "flag_future_date": {"claim_id": "f", "service_date": "2001-07-01"},
        "flag_null_service_date": {"claim_id": "d", "service_date": None},
        "flag_null_icd10": {"claim_id": "i", "icd10_primary": None},
    }
    raw = claim(spark, *cases.values(), {"claim_id": "ok", "claim_amount": 500_000.0}, {"claim_id": "unknown", "claim_amount": None})
    clean = silver.clean_claims(raw, PARAMS)
    for flag in cases:
        assert clean.filter(flag).count() == 1, flag
    verdicts = {r["claim_id"]: r["_quality_pass"] for r in clean.collect()}
    assert verdicts["ok"] is True and verdicts["unknown"] is None and verdicts["z"] is False
    assert tuple(validation.quality_summary(clean).first()) == (10, 1, 8, 1)
    assert validation.flag_breakdown(clean, C.flags()).first()["flag_bronze_null"] == 2


def test_derived_features(spark):
    raw = claim(
        spark,
        {},
        {"claim_id": "b", "service_date": None, "claim_amount": None, "service_type": "lab"},
        {"claim_id": "c", "service_date": "1997-12-31", "claim_amount": 4999.99, "service_type": "primary"},
        {"claim_id": "d", "claim_amount": 499.99}, {"claim_id": "e", "claim_amount": 5000.0},
    )
    rows = {r["claim_id"]: r for r in silver.clean_claims(raw, PARAMS).collect()}
    saturday = rows["C1"]
    assert saturday["day_of_week"] == 7 and saturday["is_weekend"] and saturday["service_quarter"] == 1
    assert saturday["period"] == "post" and saturday["is_inpatient"] and not saturday["is_ed_visit"]
    assert rows["b"]["period"] == "pre" and rows["b"]["cost_tier"] == "high"
    assert rows["c"]["period"] == "pre" and rows["c"]["cost_tier"] == "medium" and rows["c"]["is_primary_care"]
    assert rows["d"]["cost_tier"] == "low" and rows["e"]["cost_tier"] == "high"


def test_member_profile(spark):
    rows = [("A", 68, "F"), ("B", None, None), ("C", -1, "M"), ("D", 121, "M"), ("E", 120, "F"), ("F", 64, "M")]
    raw = spark.createDataFrame(rows, "bene_id string, age int, sex string").withColumns(
        {"dual_eligible": F.lit("1"), "enrollment_date": F.lit("1990-01-02")}
    )
    out = {r["bene_id"]: r for r in members.member_profile(raw, PARAMS).collect()}
    assert out["A"]["age_bracket"] == 65 and out["A"]["demographic_raf"] == 0.382 and out["A"]["is_aged"]
    assert out["B"]["demographic_raf"] == 0.45 and out["B"]["age_bracket"] is None and out["B"]["flag_invalid_age"] is None
    assert out["B"]["flag_null_sex"] and not out["A"]["flag_null_sex"]
    assert out["C"]["flag_invalid_age"] and out["C"]["age_bracket"] == -5 and out["D"]["flag_invalid_age"]
    assert not out["E"]["flag_invalid_age"] and not out["F"]["is_aged"]
    assert out["A"]["dual_eligible"] == 1 and out["A"]["enrollment_date"] == dt.date(1990, 1, 2)


def test_schema_validation(spark):
    df = spark.createDataFrame([("a", "1")], "claim_id string, claim_year string")
    found = validation.schema_differences(df, schemas.CLAIMS)
    assert "claim_year is string, declared int" in map(str, found)
    assert len(found) == 13
    try:
        validation.require_schema(df, schemas.CLAIMS)
        raise AssertionError("a schema that falls short was accepted")
    except ValueError as error:
        assert "bene_id is absent, declared string" in str(error)
    counted = {r["column_name"]: (r["issue"], r["n_rows"]) for r in validation.schema_issues(df, schemas.CLAIMS).collect()}
    assert counted["bene_id"] == ("MISSING", 1) and counted["claim_year"] == ("TYPE MISMATCH", 0)
    assert validation.schema_issues(claim(spark, {}), schemas.CLAIMS).count() == 0


def test_null_profiles(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("x", 2)], "a string, b int")
    assert validation.count_nulls(df).first().asDict() == {"a": 2, "b": 1}
    assert {tuple(r) for r in validation.null_profile(df).collect()} == {("a", 2), ("b", 1)}


def test_one_winner_of_a_tie_for_every_column_list(spark):
    same = {"claim_id": "C", "bene_id": "B", "service_date": "1999-01-01", "paid_amount": 10.0}
    rows = claim(spark, {**same, "service_type": "lab"}).unionByName(claim(spark, {**same, "service_type": "ip_admit"}))
    lists = [None, (), ("service_type",), ("allowed_amount", "icd10_codes"), ("provider_specialty", "plan_type")]
    winners = set()
    for needed in lists:
        wanted = None if needed is None else (*needed, "service_type")
        out = silver.clean_claims(rows, PARAMS, wanted)
        winners.add(out.select("service_type").first()[0])
        assert out.count() == 1 and "_tie" not in out.columns
    assert len(winners) == 1


def test_sums_do_not_depend_on_the_order_of_addition(spark):
    amounts = spark.range(2_000_000).select(((F.col("id") * 7919) % 900_000_000 / 100).alias("amount"))
    totals = {
        amounts.repartition(n, F.xxhash64("amount", F.lit(n))).agg(X.exact_sum("amount")).first()[0] for n in range(1, 9)
    }
    assert len(totals) == 1


def test_flags_are_those_of_the_rules():
    from claimlake.operators.claims import flags, quality_rules

    assert flags() == tuple(quality_rules(PARAMS)) and len(flags()) == 9
