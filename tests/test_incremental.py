"""Batches land exactly once, and Silver follows them month by month."""

import dataclasses
import tempfile
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimlake.operators import merge
from claimlake.plans import pipeline, silver
from claimlake.plans.pipeline import TableNames
from claimlake.sources import files, fixtures, schemas, tables
from claimlake.streaming.ingest import land_stream

PARAMS = fixtures.FIXTURE_PARAMS


def named(prefix):
    return TableNames(*(f"{prefix}_{layer}" for layer in ("bronze", "silver", "gold", "features")))


def rows(spark, name):
    df = spark.table(name).drop(*pipeline.AUDIT)
    columns = sorted(c for c in df.columns if c != "hcc_list")
    return Counter(tuple(r) for r in df.select(*columns).collect())


def landing(spark, sf_dir, *parts):
    """A folder of CSV claims per part, and the members."""
    base = Path(tempfile.mkdtemp(prefix="claimlake-increments-"))
    for number, part in enumerate(parts, 1):
        files.write_csv(part.coalesce(1), str(base / f"claims{number}"))
    fixtures.members(spark, sf_dir).write.parquet(str(base / "members.parquet"))
    return base


def land(spark, base, number, names):
    return pipeline.run_bronze(spark, str(base / f"claims{number}"), str(base / "members.parquet"), f"b{number}", names)


@pytest.fixture(scope="module")
def batches(spark, sf_dir):
    """Claims up to 1997; those of early 1998 with corrections of December 1997 and a bad date; nothing new."""
    claims = fixtures.claims(spark, sf_dir)
    early = claims.filter("claim_year <= 1997")
    corrected = early.filter("claim_year = 1997 AND claim_month = 12").withColumn("paid_amount", F.col("paid_amount") + 1)
    again = early.filter("claim_year = 1997 AND claim_month = 11").limit(20)
    second = claims.filter("claim_year = 1998 AND claim_month <= 2").unionByName(corrected).unionByName(again)
    return landing(spark, sf_dir, early, second, early.limit(0))


@pytest.fixture(scope="module")
def refreshed(spark, batches):
    names = named("inc")
    land(spark, batches, 1, names)
    pipeline.run_silver(spark, PARAMS, names)
    before = partition_files(spark, names)
    land(spark, batches, 2, names)
    result = pipeline.refresh_silver(spark, PARAMS, names)
    return names, before, result


def partition_files(spark, names):
    found = spark.table(names.clean_claims).select("service_year", "service_month", F.input_file_name().alias("file")).distinct()
    return {(r.service_year, r.service_month, r.file) for r in found.collect()}


def test_refresh_equals_a_full_run(spark, refreshed):
    names, _, result = refreshed
    whole = dataclasses.replace(names, silver="inc_whole")
    whole.create_schemas(spark)
    pipeline.run_silver(spark, PARAMS, whole)
    for name in ("clean_claims", "mapped_claims", "member_profile"):
        assert rows(spark, getattr(names, name)) == rows(spark, getattr(whole, name))
    assert result["batches"] == ["b2"]


def test_refresh_replaces_touched_months_alone(spark, refreshed):
    names, before, result = refreshed
    after = partition_files(spark, names)
    changed = {(y, m) for y, m, _ in before ^ after}
    arrived = spark.table(names.raw_claims).filter("_batch_id = 'b2'")
    assert changed <= {tuple(r) for r in silver.service_months(arrived).collect()} and result["months"] < 8
    assert {(1997, 12), (1998, 1), (1998, 2)} <= changed and (1995, 3) not in changed


def test_refresh_reads_touched_months_alone(spark, refreshed):
    names, *_ = refreshed
    arrived = spark.table(names.raw_claims).filter("_batch_id = 'b2'").drop(*pipeline.AUDIT)
    months = silver.service_months(arrived).collect()
    touched = tables.in_partitions(tables.PARTITIONS["clean_claims"], months)
    former = spark.table(names.clean_claims).filter(touched)
    plan = silver.refreshed_claims(former, arrived, PARAMS)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "clean_claims" in line]
    assert scans and all("PartitionFilters: [(" in line and "service_year" in line for line in scans)
    assert len(former.inputFiles()) < len(spark.table(names.clean_claims).inputFiles()) / 5


def test_nothing_new_changes_nothing(spark, batches, refreshed):
    names, *_ = refreshed
    before = partition_files(spark, names)
    assert pipeline.refresh_silver(spark, PARAMS, names)["batches"] == []
    land(spark, batches, 3, names)  # an empty batch
    assert pipeline.refresh_silver(spark, PARAMS, names)["batches"] == ["b3"]
    assert partition_files(spark, names) == before


def test_refresh_repeats_after_a_failure(spark, batches, monkeypatch):
    names = named("inc_fail")
    land(spark, batches, 1, names)
    pipeline.run_silver(spark, PARAMS, names)
    land(spark, batches, 2, names)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(silver, "mapped_claims", broken)
        with pytest.raises(RuntimeError):
            pipeline.refresh_silver(spark, PARAMS, names)
    pipeline.refresh_silver(spark, PARAMS, names)
    whole = dataclasses.replace(names, silver="inc_fail_whole")
    whole.create_schemas(spark)
    pipeline.run_silver(spark, PARAMS, whole)
    assert rows(spark, names.clean_claims) == rows(spark, whole.clean_claims)
    assert rows(spark, names.mapped_claims) == rows(spark, whole.mapped_claims)


def test_keys_without_the_date_are_refused(spark, sf_dir):
    raw = fixtures.claims(spark, sf_dir)
    with pytest.raises(ValueError, match="any month"):
        silver.refreshed_claims(raw, raw, dataclasses.replace(PARAMS, dedup_keys=("claim_id",)))


@pytest.mark.parametrize("step", ["quarantine", "ledger"])
def test_a_batch_lands_once_whatever_fails(spark, sf_dir, monkeypatch, step):
    names = named(f"once_{step}")
    base = landing(spark, sf_dir, fixtures.claims(spark, sf_dir).filter("claim_year = 1995").limit(80), fixtures.claims(spark, sf_dir).limit(5))
    (base / "claims1" / "late.csv").write_text(",".join(schemas.CLAIMS.names) + "\nonly,three,fields\n")
    land(spark, base, 2, names)
    write, record, calls = tables.write_table, tables.record_batch, []

    def write_fails(df, name, *args, **kwargs):
        if name == names.quarantined:
            raise RuntimeError("lost")
        return write(df, name, *args, **kwargs)

    def record_fails(spark, name, batch_id, n, status=tables.LANDED_BATCH):
        calls.append(status)
        if status == tables.LANDED_BATCH:
            raise RuntimeError("lost")
        return record(spark, name, batch_id, n, status)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_table" if step == "quarantine" else "record_batch", write_fails if step == "quarantine" else record_fails)
        with pytest.raises(RuntimeError):
            land(spark, base, 1, names)
    assert tables.landed_batches(spark, names.raw_claims) == ["b2"]
    assert spark.table(names.raw_claims).filter("_batch_id = 'b1'").count() == 80  # written, not landed
    assert pipeline.run_silver(spark, PARAMS, names)["clean_claims_rows"] <= 5
    again = land(spark, base, 1, names)
    assert (again["claims_rows"], again["malformed_rows"]) == (80, 1)
    counts = {r["_batch_id"]: r["count"] for r in spark.table(names.raw_claims).groupBy("_batch_id").count().collect()}
    assert counts == {"b1": 80, "b2": 5} and spark.table(names.quarantined).count() == 1
    assert land(spark, base, 1, names)["claims_rows"] == 0


def test_a_batch_of_malformed_lines_alone(spark, sf_dir):
    names, base = named("all_bad"), landing(spark, sf_dir, fixtures.claims(spark, sf_dir).limit(0))
    (base / "claims1" / "late.csv").write_text(",".join(schemas.CLAIMS.names) + "\nonly,three,fields\n")
    got = land(spark, base, 1, names)
    assert (got["claims_rows"], got["malformed_rows"]) == (0, 1) and spark.table(names.quarantined).count() == 1


def test_malformed_members_are_kept(spark, sf_dir):
    names = named("bad_members")
    base = Path(tempfile.mkdtemp(prefix="claimlake-members-"))
    files.write_csv(fixtures.claims(spark, sf_dir).limit(5).coalesce(1), str(base / "claims"))
    files.write_csv(fixtures.members(spark, sf_dir).limit(30).coalesce(1), str(base / "members"))
    (base / "members" / "late.csv").write_text(",".join(schemas.MEMBERS.names) + "\nBNE1,old,F\n")
    for batch in ("1", "1", "2"):
        result = pipeline.run_bronze(spark, str(base / "claims"), str(base / "members"), batch, names)
        assert result["members_rows"] == 30 and result["malformed_members"] == 1
    kept = spark.table(names.quarantined_members)
    assert sorted(r["_batch_id"] for r in kept.collect()) == ["1", "2"]
    assert all("BNE1,old,F" in r[schemas.CORRUPT] for r in kept.collect())


def test_stream_lands_batches_exactly_once(spark, sf_dir, monkeypatch):
    names, base = named("stream"), Path(tempfile.mkdtemp(prefix="claimlake-land-stream-"))
    claims, record = fixtures.claims(spark, sf_dir), tables.record_batch

    def run():
        query = land_stream(spark, str(base / "in"), str(base / "progress"), names)
        query.awaitTermination(120)
        return query

    files.write_csv(claims.filter("claim_year = 1995").limit(90), str(base / "in"), "append")
    run()
    files.write_csv(claims.filter("claim_year = 1996").limit(60), str(base / "in"), "append")

    def record_fails(spark, name, batch_id, n, status=tables.LANDED_BATCH):
        if status == tables.LANDED_BATCH:
            raise RuntimeError("lost between data and ledger")
        return record(spark, name, batch_id, n, status)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "record_batch", record_fails)
        with pytest.raises(Exception, match="lost between"):
            run()
    assert tables.read_table(spark, names.raw_claims).count() == 150 and len(tables.landed_batches(spark, names.raw_claims)) == 1
    run()
    run()
    counts = [r["count"] for r in tables.read_table(spark, names.raw_claims).groupBy("_batch_id").count().orderBy("_batch_id").collect()]
    assert counts == [90, 60]
    fixtures.members(spark, sf_dir).createOrReplaceTempView("m")
    tables.write_layer_table(spark.table("m").withColumn("_bronze_null_flag", F.lit(False)), names.raw_members)
    assert pipeline.run_silver(spark, PARAMS, names)["clean_claims_rows"] == 150


def test_guard_follows_the_ledger(spark, sf_dir):
    ledger = fixtures.ledger_of_first_batch(spark, sf_dir)
    incoming = fixtures.first_batch(spark, sf_dir).unionByName(fixtures.second_batch(spark, sf_dir))
    seen = lambda kept: {r["_batch_id"] for r in merge.only_new_batches(incoming, kept).select("_batch_id").distinct().collect()}
    assert seen(ledger) == {"2"} and seen(ledger.limit(0)) == {"1", "2"}
