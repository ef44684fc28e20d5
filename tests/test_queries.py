"""Every registered query against its SQL, and the shape of key plans."""

import pytest

import __spark_entry__ as entry
from claimlake import oracles
from claimlake.plans import catalog
from claimlake.sources import fixtures
from tests.compare import connect, difference, duck_rows, spark_rows

QUERIES, SQL = catalog.registered(), oracles.compose()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


#: Fitted values, which SQL cannot give; test_model_values.py holds them against what they must be.
FITTED = {"ml_member_predictions"}


def test_every_query_has_sql():
    assert set(QUERIES) - FITTED == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_values_agree(spark, sf_dir, duck, name):
    assert difference(spark_rows(QUERIES[name](spark, sf_dir)), duck_rows(duck, SQL[name])) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


MODELS = {name for name in QUERIES if name.startswith("ml_")}


@pytest.mark.parametrize("name", sorted(set(SQL) - MODELS))
def test_plans_stay_in_the_jvm_and_avoid_cross_joins(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text, unwanted


def test_trends_read_and_shuffle_only_what_they_use(spark, sf_dir):
    text = plan(spark, sf_dir, "gold_monthly_trends")
    # of the text columns only the digest that breaks ties is shuffled
    assert "AS _tie" in text
    for unused in ("icd10_codes#", "provider_specialty#"):
        assert all(unused not in line for line in text.split("\n") if "Exchange" in line or "Sort" in line)
    for unused in ("o_orderstatus", "l_returnflag", "l_shipmode"):
        assert unused not in text
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in text


def test_rollup_needs_no_row_expansion(spark, sf_dir):
    for name in ("gold_member_rollup", "gold_utilization", "gold_pre_utilization"):
        assert "Expand" not in plan(spark, sf_dir, name)


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().statusStore().jobsList(None).size()


def test_building_a_query_starts_no_job(spark, sf_dir):
    for name in sorted(set(QUERIES) - MODELS):
        QUERIES[name](spark, sf_dir)  # reading a schema may need a job once
        before = jobs(spark)
        spark.sparkContext.setJobGroup("building", name)
        QUERIES[name](spark, sf_dir)
        started = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert before >= 0 and [s for s in started if not reads_a_schema(spark, s)] == [], name


def reads_a_schema(spark, job: int) -> bool:
    """Parquet footers are read by a job of one task."""
    info = spark.sparkContext.statusTracker().getJobInfo(job)
    stages = [spark.sparkContext.statusTracker().getStageInfo(s) for s in info.stageIds]
    return all(s is None or s.numTasks == 1 and "parquet" in s.name for s in stages)


def scans(text: str) -> int:
    return text.count("FileScan parquet")


def test_scans_and_sorts(spark, sf_dir):
    assert scans(plan(spark, sf_dir, "bronze_batch_guard")) <= 6
    assert scans(plan(spark, sf_dir, "gold_table_rows")) <= 4
    for name in ("gold_did_estimate", "gold_pre_trend_slopes"):
        assert "rangepartitioning" not in plan(spark, sf_dir, name)


def test_the_claims_view_keeps_every_line(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert fixtures.claims(spark, sf_dir).count() == lines
    scores = QUERIES["gold_raf_scores"](spark, sf_dir)
    assert scores.filter("total_claims = 0").count() > 0
