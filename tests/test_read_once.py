"""Work that several steps of a query share is done once, and training tasks follow rows and cores."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from claimlake import Params
from claimlake.operators import explain, modeling
from claimlake.plans import catalog
from tests.test_queries import plan


@pytest.fixture
def fixed_plans(spark):
    """Plans that show which shuffles are read again."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def line_scans(text: str) -> int:
    return sum("FileScan parquet" in line and "l_orderkey" in line for line in text.split("\n"))


def members(spark, n=400):
    """A store of its own rows: tier and cost follow from one feature."""
    score = F.col("id") % 7
    tier = F.when(score < 3, "low").when(score < 5, "moderate").otherwise("high")
    return spark.range(n).select(
        F.concat(F.lit("m"), "id").alias("bene_id"), tier.alias("risk_tier"), score.cast("double").alias("age"),
        (score * 1000.0 + 1).alias("estimated_annual_cost"),
    )


# F1 to F5, F7


def test_split_members_do_not_bring_the_claims_along(spark, sf_dir):
    for part in catalog._split_store(catalog.Lake(spark, sf_dir)):
        assert line_scans(part._jdf.queryExecution().executedPlan().toString()) == 0


def test_training_tasks_follow_the_cores(spark, monkeypatch):
    seen, real = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or real(self, df))
    modeling.RiskModel(Params(n_trees=2, max_depth=2), ("age",)).fit(members(spark).repartition(50), calibrate=False)
    assert seen == [spark.sparkContext.defaultParallelism]


def test_training_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(modeling, "ROWS_PER_TASK", 20)
    cores = spark.sparkContext.defaultParallelism
    assert modeling.laid_out(members(spark)).rdd.getNumPartitions() == cores * -(-400 // (20 * cores))


def test_models_do_not_depend_on_the_order_of_rows(spark):
    rows, params = members(spark), Params(n_trees=3, max_depth=3, calibration_folds=2)
    for orders in ([rows.repartition(3), rows.orderBy(F.desc("bene_id"))], ):
        fitted = [modeling.RiskModel(params, ("age",)).fit(df).predict(rows) for df in orders]
        assert sorted(fitted[0].collect()) == sorted(fitted[1].collect())


def test_laid_out_rows_with_null_and_repeated_keys(spark):
    rows = members(spark, 30).unionByName(members(spark, 30)).withColumn("bene_id", F.when(F.col("age") > 1, F.col("bene_id")))
    assert sorted(map(str, modeling.laid_out(rows).collect())) == sorted(map(str, rows.collect()))


# F6


def test_grid_is_counted_once(spark):
    scored = spark.createDataFrame([(0.1, 0), (0.1, 1), (0.9, 1)], "s double, hit int")
    grid = modeling.calibration_grid(scored, "s", F.col("hit") == 1, Params())
    assert "Aggregate" not in grid._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, grid.collect())) == [(0.1, 0.5, 2.0), (0.9, 1.0, 1.0)]


# F8, F10, F12


@pytest.mark.parametrize("name", ["drift_bins", "drift_histogram", "drift_report", "drift_overall"])
def test_drift_cleans_the_claims_once(spark, sf_dir, fixed_plans, name):
    assert line_scans(plan(spark, sf_dir, name)) == 1


# F9


def test_permutation_reads_a_kept_matrix(spark):
    matrix = members(spark).groupBy("bene_id").agg(F.max("age").alias("age"), F.max("risk_tier").alias("risk_tier"))
    guess = lambda df: df.withColumn("g", F.when(F.col("age") < 3, "low").when(F.col("age") < 5, "moderate").otherwise("high"))
    ranked = explain.permutation_importance(matrix, ["age"], guess, F.col("g") == F.col("risk_tier"), "bene_id")
    assert "max(" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    assert ranked.first().score == 1.0 and ranked.first().importance > 0


# F11


def test_refresh_shuffles_digests_instead_of_texts(spark, sf_dir, fixed_plans):
    text = plan(spark, sf_dir, "silver_refreshed")
    # the first batch, the months of the second, the second
    assert line_scans(text) == 3
    assert all("icd10_codes#" not in line for line in text.split("\n") if "Window" in line or "Sort" in line)
