import pytest
from pyspark.sql import functions as F

from claimlake.codes import CATEGORIES, CONDITIONS, CROSSWALK, FEATURES, LEAK_FREE_FEATURES
from claimlake.functions import clinical
from claimlake.operators import mapping


def test_code_tables():
    assert len(CROSSWALK) == len({r.icd10_code for r in CROSSWALK}) == 50
    assert len(CATEGORIES) == 26
    assert len(FEATURES) == len(set(FEATURES)) == 33
    assert set(LEAK_FREE_FEATURES) < set(FEATURES)
    assert len(CONDITIONS) == 8


@pytest.mark.parametrize(
    "codes, hccs, weight",
    [
        ("I500", [85], 0.323),
        ("I500|E119", [19, 85], 0.441),
        ("I500|I501", [85], 0.323),
        ("I500|E119|N183", [19, 85, 138], 0.512),
        (" i500 | e119\t|zz", [19, 85], 0.441),
        ("XXXX", [], 0.0),
        ("", [], 0.0),
        (None, [], 0.0),
    ],
)
def test_hcc_list_and_weight(spark, codes, hccs, weight):
    df = spark.createDataFrame([(codes,)], "codes string")
    listed = df.select(clinical.hcc_list(F.col("codes")).alias("h"))
    row = listed.select("h", clinical.hcc_weight_total(F.col("h")).alias("w")).first()
    assert row["h"] == hccs and row["w"] == weight


def test_primary_condition(spark):
    df = spark.createDataFrame([("I500",), (" i480 ",), ("XXXXX",), ("",), (None,)], "c string")
    rows = df.select(clinical.primary_hcc(F.col("c")).alias("n"), clinical.primary_hcc_desc(F.col("c")).alias("d"))
    assert [tuple(r) for r in rows.collect()] == [
        (85, "Congestive Heart Failure"),
        (96, "Atrial Fibrillation / Flutter"),
        (None, "Unknown / Not Mapped"),
        (None, None),
        (None, None),
    ]


@pytest.mark.parametrize(
    "sex, age, weight",
    [("F", 75, 0.453), ("M", 80, 0.549), ("F", 100, 0.712), ("M", 20, 0.346), ("F", 68, 0.382),
     ("F", 67, 0.321), ("X", 70, 0.45), (None, 70, 0.45), ("F", None, 0.45)],
)
def test_demographic_weight(spark, sex, age, weight):
    df = spark.createDataFrame([(sex, age)], "sex string, age int")
    assert df.select(clinical.demographic_raf(F.col("sex"), F.col("age"))).first()[0] == weight


def test_demographic_table_join_agrees_with_map(spark):
    people = spark.range(60, 101).select(
        F.col("id").cast("int").alias("age"), F.when(F.col("id") % 2 == 0, "F").otherwise("M").alias("sex")
    )
    mapped = people.withColumn("mapped", clinical.demographic_raf(F.col("sex"), F.col("age")))
    keyed = mapped.withColumn("bracket", clinical.nearest_bracket(F.col("age")))
    joined = keyed.join(clinical.demographic_frame(spark), ["sex", "bracket"], "left")
    assert joined.filter(F.col("mapped") != F.col("demographic_raf")).count() == 0
    assert joined.filter(F.col("demographic_raf").isNull()).count() == 0


def test_flags_and_interactions(spark):
    df = spark.createDataFrame([("I500|I480|E1140|N184", "I500"), ("C7951", "C7951")], "icd10_codes string, icd10_primary string")
    heart, cancer = mapping.map_claims(df).collect()
    assert heart["has_chf"] and heart["has_afib"] and heart["has_diabetes"] and heart["has_ckd"]
    assert heart["hcc_interaction_total"] == pytest.approx(0.487)
    assert heart["hcc_burden_count"] == 4
    assert cancer["has_cancer"] and cancer["has_metastatic"] and cancer["hcc_interaction_total"] == 0.0


def test_sql_functions_match_expressions(spark):
    clinical.register_sql_functions(spark)
    row = spark.sql(
        """SELECT icd_to_hcc_list('I500| e119|zz') AS l, icd_to_hcc_raf_total('I500|E119') AS w,
                  icd_to_hcc_list(CAST(NULL AS STRING)) AS none, icd_to_primary_hcc('G20') AS p,
                  icd_to_primary_hcc_desc('G20') AS d, icd_to_primary_hcc_desc('zz') AS u,
                  icd_to_primary_hcc('') AS e"""
    ).first()
    assert tuple(row) == ([19, 85], 0.441, [], 78, "Parkinson's Disease", "Unknown / Not Mapped", None)


def test_join_form_matches_expression_form(spark):
    df = spark.createDataFrame(
        [(1, "I500|E119"), (2, None), (3, "zz"), (4, "I500|i501 |C349")], "id int, icd10_codes string"
    ).withColumn("icd10_primary", F.lit("I500"))
    df = df.withColumn("icd10_primary", F.expr("CASE id WHEN 1 THEN ' i500' WHEN 2 THEN '' WHEN 3 THEN 'zz' END"))
    direct = mapping.map_claims(df).drop("icd10_codes", "icd10_primary")
    joined = mapping.map_by_join(df, clinical.crosswalk_frame(spark), ["id"]).select(*direct.columns)
    assert {str(r) for r in joined.collect()} == {str(r) for r in direct.collect()}
