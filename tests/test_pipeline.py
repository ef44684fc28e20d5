import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimlake.plans import catalog, pipeline
from claimlake.plans.pipeline import TableNames
from claimlake.sources import files, fixtures, schemas
from claimlake.streaming.ingest import ingest_new_files

NAMES = TableNames("p_bronze", "p_silver", "p_gold", "p_features")


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    base = Path(tempfile.mkdtemp(prefix="claimlake-landing-"))
    files.write_csv(fixtures.claims(spark, sf_dir), str(base / "claims"))
    fixtures.members(spark, sf_dir).write.parquet(str(base / "members.parquet"))
    result = pipeline.run_all(
        spark, str(base / "claims"), str(base / "members.parquet"), fixtures.FIXTURE_PARAMS, "20240101000000", NAMES
    )
    return base, result


def test_row_counts(spark, landed):
    _, result = landed
    assert result["bronze"]["claims_rows"] == 6000 and result["bronze"]["members_rows"] == 150
    assert result["silver"] == {"clean_claims_rows": 5998, "hcc_mapped_rows": 5588, "member_profile_rows": 150}
    assert result["gold"]["raf_rows"] == result["gold"]["feature_rows"] == 150
    assert sum(result["gold"]["tier_counts"].values()) == 150


@pytest.mark.parametrize(
    "table, query", [(NAMES.trends, "gold_monthly_trends"), (NAMES.raf_scores, "gold_raf_scores"), (NAMES.feature_store, "gold_feature_store")]
)
def test_tables_equal_direct_queries(spark, landed, sf_dir, table, query):
    stored = spark.table(table).drop(*pipeline.AUDIT)
    direct = catalog.registered()[query](spark, sf_dir)
    names = sorted(direct.columns)
    doubles = [n for n, t in direct.dtypes if t == "double"]
    shown = lambda df: df.select(*[F.round(n, 6).alias(n) if n in doubles else F.col(n) for n in names])
    assert shown(stored).exceptAll(shown(direct)).count() == 0
    assert stored.count() == direct.count()


def test_layout(spark, landed):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {NAMES.clean_claims}").collect()
    listed = [r["col_name"] for r in described]
    at = listed.index("# Partition Information")
    assert listed[at + 2 : at + 4] == ["service_year", "service_month"]


def test_same_batch_is_not_landed_twice(spark, landed):
    base, _ = landed
    again = pipeline.run_bronze(
        spark, str(base / "claims"), str(base / "members.parquet"), "20240101000000", NAMES
    )
    assert again["claims_rows"] == 0 and again["members_rows"] == 150
    assert spark.table(NAMES.raw_claims).count() == 6000
    other = pipeline.run_bronze(
        spark, str(base / "claims"), str(base / "members.parquet"), "20240102000000", NAMES
    )
    assert other["claims_rows"] == 6000 and spark.table(NAMES.raw_claims).count() == 2 * 6000


def test_malformed_lines_go_to_quarantine(spark, sf_dir):
    base, names = Path(tempfile.mkdtemp(prefix="claimlake-bad-")), TableNames("q_bronze", "q_silver", "q_gold", "q_features")
    files.write_csv(fixtures.claims(spark, sf_dir).limit(50).coalesce(1), str(base / "claims"))
    lines = [",".join(schemas.CLAIMS.names), "only,three,fields", "CLM9,BNE9,1999-01-01,notayear,1,lab,I500,I500,01,1.0,1.0,1.0,HMO,0"]
    (base / "claims" / "late.csv").write_text("\n".join(lines) + "\n")
    fixtures.members(spark, sf_dir).write.parquet(str(base / "members.parquet"))
    result = pipeline.run_bronze(spark, str(base / "claims"), str(base / "members.parquet"), "1", names)
    assert result["claims_rows"] == 50 and result["malformed_rows"] == 2
    assert spark.table(names.raw_claims).count() == 50 and spark.table(names.quarantined).count() == 2


def test_stream_lands_each_file_once(spark, sf_dir):
    base = Path(tempfile.mkdtemp(prefix="claimlake-stream-"))
    claims = fixtures.claims(spark, sf_dir)

    def land(batch):
        query = ingest_new_files(spark, str(base / "in"), str(base / "table"), batch, str(base / "progress"))
        assert query.awaitTermination(120)
        return spark.read.parquet(str(base / "table"))

    files.write_csv(claims.limit(100), str(base / "in"), "append")
    assert land("b1").count() == 100
    assert land("b2").count() == 100
    files.write_csv(claims.limit(40), str(base / "in"), "append")
    table = land("b3")
    assert {r["_batch_id"]: r["count"] for r in table.groupBy("_batch_id").count().collect()} == {"b1": 100, "b3": 40}
    assert set(schemas.CLAIMS.names) <= set(table.columns)
