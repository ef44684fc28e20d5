import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimlake.operators import merge
from claimlake.sources import files, fixtures, schemas, tables


def folder(name):
    return str(Path(tempfile.mkdtemp(prefix="claimlake-test-")) / name)


@pytest.fixture(scope="module")
def some_claims(spark, sf_dir):
    return fixtures.claims(spark, sf_dir).orderBy("claim_id", "service_date", "paid_amount").limit(300)


def test_declared_schemas(spark, sf_dir):
    claims, members = fixtures.claims(spark, sf_dir), fixtures.members(spark, sf_dir)
    for frame, declared in ((claims, schemas.CLAIMS), (members, schemas.MEMBERS)):
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in declared]


def test_csv_round_trip_keeps_malformed_lines(spark, some_claims):
    path = folder("claims")
    files.write_csv(some_claims.coalesce(1), path)
    lines = [",".join(schemas.CLAIMS.names), "only,three,fields",
             "CLM9,BNE9,1999-01-01,notayear,1,lab,I500,I500,01,1.0,1.0,1.0,HMO,0"]
    (Path(path) / "late.csv").write_text("\n".join(lines) + "\n")
    back = files.read_auto(spark, path, schemas.CLAIMS)
    good, bad = files.quarantine(back.cache())
    assert good.count() == 300 and bad.count() == 2
    assert {r["_corrupt_record"].split(",")[0] for r in bad.collect()} == {"only", "CLM9"}
    assert good.exceptAll(some_claims).count() == 0
    with pytest.raises(Exception):
        files.read_csv(spark, path, schemas.CLAIMS, strict=True).collect()


def test_parquet_by_suffix(spark, some_claims):
    path = folder("claims.parquet")
    some_claims.write.parquet(path)
    assert files.read_auto(spark, path, schemas.CLAIMS).count() == 300
    assert files.quarantine(files.read_parquet(spark, path))[1].count() == 0


def test_write_counts_rows_and_partitions(spark, some_claims):
    n = tables.write_table(some_claims, "t_written", partition_by=["claim_year"], cluster_by=["bene_id"])
    assert n == 300 == spark.table("t_written").count()
    assert tables.table_exists(spark, "t_written") and not tables.table_exists(spark, "t_absent")
    located = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")) / "t_written"
    assert list(located.glob("claim_year=*"))


def test_hot_key_spreads_over_files(spark):
    df = spark.range(20_000).select(F.lit("same").alias("k"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spread = tables.clustered(df, cluster_by=["k"])
    sizes = [r["n"] for r in spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_batch_guard(spark):
    rows = spark.range(5).withColumn("_batch_id", F.lit("b1"))
    tables.record_batch(spark, "t_led", "b9", 3)
    assert tables.batch_already_ingested(spark, "t_led", "b9") and not tables.batch_already_ingested(spark, "t_led", "b1")
    assert not tables.batch_already_ingested(spark, "t_guard", "b1")
    tables.write_table(rows, "t_guard", "append")
    assert tables.batch_already_ingested(spark, "t_guard", "b1")
    assert not tables.batch_already_ingested(spark, "t_guard", "b2")
    incoming = rows.unionByName(rows.withColumn("_batch_id", F.lit("b2")))
    assert {r["_batch_id"] for r in merge.only_new_batches(incoming, spark.table("t_guard")).collect()} == {"b2"}


def test_append_with_schema_evolution(spark):
    tables.write_table(spark.range(3), "t_evolve", "append")
    wider = spark.range(2).withColumn("extra", F.lit("x"))
    with pytest.raises(ValueError, match="extra"):
        tables.write_table(wider, "t_evolve", "append")
    tables.write_table(wider, "t_evolve", "append", merge_schema=True)
    tables.write_table(spark.range(1), "t_evolve", "append", merge_schema=True)
    rows = [tuple(r) for r in spark.table("t_evolve").select("id", "extra").collect()]
    assert sorted(rows, key=str) == sorted([(0, None), (1, None), (2, None), (0, "x"), (1, "x"), (0, None)], key=str)


def test_upsert_semantics(spark):
    schema = "k string, j int, v string"
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "old")], schema)
    updates = spark.createDataFrame([("a", 1, "new"), ("c", 1, "new"), (None, 1, "new")], schema)
    want = {("a", 1, "new"), ("b", 1, "old"), ("c", 1, "new"), (None, 1, "old"), (None, 1, "new")}
    assert {tuple(r) for r in merge.merge_upsert(target, updates, ["k", "j"]).collect()} == want
    assert tables.upsert_table(spark, target, "t_upsert", ["k", "j"]) == 3
    assert tables.upsert_table(spark, updates, "t_upsert", ["k", "j"]) == 5
    assert {tuple(r) for r in spark.table("t_upsert").collect()} == want
    repeated = updates.filter("k = 'a'").unionByName(updates.filter("k = 'a'"))
    with pytest.raises(ValueError, match="repeat"):
        tables.upsert_table(spark, repeated, "t_upsert", ["k", "j"])


def test_upsert_is_idempotent(spark):
    updates = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k int, v string")
    tables.upsert_table(spark, updates, "t_again", ["k"])
    before = {tuple(r) for r in spark.table("t_again").collect()}
    assert tables.upsert_table(spark, updates, "t_again", ["k"]) == 20
    assert {tuple(r) for r in spark.table("t_again").collect()} == before


def test_snapshots_and_versions(spark):
    for version, n in ((1, 3), (2, 5), (4, 2)):
        tables.write_snapshot(spark.range(n), "t_snap", version)
    sizes = {v: tables.read_version(spark, "t_snap", v).count() for v in (1, 2, 3, 4)}
    assert sizes == {1: 3, 2: 5, 3: 5, 4: 2}
    assert tables.read_version(spark, "t_snap").count() == 2


def test_versions_of_an_append_only_table(spark):
    rows = spark.range(4).select(
        "id", F.concat(F.lit("2024010"), F.col("id")).alias("_batch_id"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("_ingested_at"),
    )
    tables.write_table(rows, "t_log", "append")
    assert tables.read_version(spark, "t_log", "20240101").count() == 2
    assert tables.read_version(spark, "t_log", timestamp="2024-01-03").count() == 3
    assert tables.read_version(spark, "t_log", "20240100", timestamp="2024-01-03").count() == 1


def test_partition_overwrite_leaves_others(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("p"))
    tables.write_table(df, "t_parts", partition_by=["p"])
    tables.replace_partitions(df.filter("p = 1").limit(1), "t_parts")
    assert {r["p"]: r["count"] for r in spark.table("t_parts").groupBy("p").count().collect()} == {0: 5, 1: 1}


def test_numeric_order_of_text_versions(spark):
    rows = spark.createDataFrame([("k", str(b)) for b in (1, 2, 9, 10)] + [("k", None)], "k string, _batch_id string")
    assert {r["_batch_id"] for r in merge.read_as_of(rows, "2").collect()} == {"1", "2"}
    assert {r["_batch_id"] for r in merge.read_as_of(rows, 10).collect()} == {"1", "2", "9", "10"}
    assert [r["_batch_id"] for r in merge.latest_per_key(rows, ["k"]).collect()] == ["10"]


def test_versions_need_a_history(spark):
    tables.write_table(spark.range(3).withColumn("_batch_id", F.lit("2")), "t_overwritten")
    with pytest.raises(ValueError, match="keeps no earlier versions"):
        tables.read_version(spark, "t_overwritten", "1")


def test_snapshots_by_time(spark):
    tables.write_snapshot(spark.range(3), "t_snap_time", 1)
    assert tables.read_version(spark, "t_snap_time", timestamp="2999-01-01").count() == 3
    assert tables.read_version(spark, "t_snap_time", timestamp="1999-01-01").count() == 0


def test_upsert_keeps_the_layout(spark, some_claims):
    columns = [*schemas.CLAIMS.names]
    first = some_claims.filter("claim_id IS NOT NULL AND bene_id IS NOT NULL").dropDuplicates(["claim_id"]).select(*columns)
    tables.upsert_table(spark, first, "raw_claims", ["claim_id"])
    assert tables.partition_columns(spark, "raw_claims") == ["claim_year", "claim_month"]
    n, named = spark.table("raw_claims").count(), "t_parted.raw_claims"
    moved = first.limit(1).withColumns({"claim_year": F.lit(2050), "plan_type": F.lit("moved")})
    key = moved.first()["claim_id"]
    alone = first.filter(F.col("claim_id") == key).withColumns({"claim_year": F.lit(2049), "claim_id": F.lit("alone")})
    assert tables.upsert_table(spark, alone, "raw_claims", ["claim_id"]) == n + 1
    # the only row of a partition moves to another one
    assert tables.upsert_table(spark, alone.withColumn("claim_year", F.lit(2051)), "raw_claims", ["claim_id"]) == n + 1
    assert tables.upsert_table(spark, moved, "raw_claims", ["claim_id"]) == n + 1
    table = spark.table("raw_claims")
    assert table.filter("claim_year = 2049").count() == 0 and table.filter("plan_type = 'moved'").count() == 1
    assert table.select("claim_id").distinct().count() == n + 1 and named
    tables.write_layer_table(first.limit(2).select(*table.columns), "raw_claims", "append")
    assert spark.table("raw_claims").count() == n + 3


def test_landing_reads_its_input_once(spark, some_claims):
    laid = tables.landed(some_claims, ("claim_year", "claim_month"), ("bene_id",))
    text = laid._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert text.count("rangepartitioning") == some_claims._jdf.queryExecution().executedPlan().toString().count("rangepartitioning")
