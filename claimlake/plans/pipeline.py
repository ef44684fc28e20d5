"""The whole batch run: landing files to Bronze, Silver, Gold and features.

Each step reads the tables of the step before it, so a failed run resumes at
the step that failed and nothing is computed twice.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.rollups import tier_counts
from claimlake.operators.validation import QUALITY_PASS, add_audit_columns, require_schema, schema_differences, tag_null_keys
from claimlake.params import Params
from claimlake.plans import gold, silver
from claimlake.sources import schemas, tables
from claimlake.sources.files import quarantine, read_auto

AUDIT = ("_ingested_at", "_pipeline_layer", "_batch_id")


@dataclass(frozen=True)
class TableNames:
    """Where each layer lives; a schema name per layer."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    features: str = "ml_features"

    def create_schemas(self, spark: SparkSession) -> None:
        for schema in (self.bronze, self.silver, self.gold, self.features):
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")

    @property
    def raw_claims(self) -> str:
        return f"{self.bronze}.raw_claims"

    @property
    def quarantined(self) -> str:
        return f"{self.bronze}.malformed_claims"

    @property
    def quarantined_members(self) -> str:
        return f"{self.bronze}.malformed_members"

    @property
    def raw_members(self) -> str:
        return f"{self.bronze}.raw_members"

    @property
    def clean_claims(self) -> str:
        return f"{self.silver}.clean_claims"

    @property
    def mapped_claims(self) -> str:
        return f"{self.silver}.hcc_mapped_claims"

    @property
    def member_profile(self) -> str:
        return f"{self.silver}.member_profile"

    @property
    def raf_scores(self) -> str:
        return f"{self.gold}.member_raf_scores"

    @property
    def utilization(self) -> str:
        return f"{self.gold}.utilization_summary"

    @property
    def trends(self) -> str:
        return f"{self.gold}.monthly_trends"

    @property
    def feature_store(self) -> str:
        return f"{self.features}.risk_feature_store"


def new_batch_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")


def _data(spark: SparkSession, name: str) -> DataFrame:
    return tables.read_table(spark, name).drop(*AUDIT)


def run_bronze(
    spark: SparkSession,
    claims_path: str,
    members_path: str,
    batch_id: str | None = None,
    names: TableNames = TableNames(),
    strict: bool = False,
) -> dict:
    """Land one batch. Claims already landed under the batch id are skipped; see ``land_claims``."""
    names.create_schemas(spark)
    batch_id = batch_id or new_batch_id()
    claims = read_auto(spark, claims_path, schemas.CLAIMS, strict)
    members = read_auto(spark, members_path, schemas.MEMBERS, strict)
    for frame, declared in ((claims, schemas.CLAIMS), (members, schemas.MEMBERS)):
        if strict:
            require_schema(frame, declared)
    issues = [
        str(d)
        for frame, declared in ((claims, schemas.CLAIMS), (members, schemas.MEMBERS))
        for d in schema_differences(frame, declared)
    ]

    claim_rows, malformed = land_claims(spark, claims, batch_id, names)
    member_rows, malformed_members = _land_members(spark, members, batch_id, names)
    return {
        "batch_id": batch_id,
        "claims_rows": claim_rows,
        "members_rows": member_rows,
        "malformed_rows": malformed,
        "malformed_members": malformed_members,
        "schema_issues": issues,
        "claims_table": names.raw_claims,
        "members_table": names.raw_members,
    }


def land_claims(
    spark: SparkSession, claims: DataFrame, batch_id: str, names: TableNames = TableNames()
) -> tuple[int, int]:
    """Append one batch of claim lines exactly once; returns usable and malformed lines.

    The ledger says that the batch has started before anything is written, and that it has
    landed when lines and quarantine are complete. A run that finds a batch started takes out
    what was left of it and lands it again; a batch that has landed is skipped. Silver reads
    landed batches alone, so a batch in the making is not seen.
    """
    status = tables.batch_status(spark, names.raw_claims, batch_id)
    if status == tables.LANDED_BATCH:
        return 0, 0
    if status == tables.STARTED_BATCH:
        for name in (names.raw_claims, names.quarantined):
            tables.remove_batch(spark, name, batch_id)
    else:
        tables.record_batch(spark, names.raw_claims, batch_id, None, tables.STARTED_BATCH)
    rows, malformed = _land(
        claims, schemas.CLAIMS, ("claim_id", "bene_id"), batch_id, names.raw_claims, names.quarantined, "append"
    )
    tables.record_batch(spark, names.raw_claims, batch_id, rows)
    return rows, malformed


def _land_members(spark: SparkSession, members: DataFrame, batch_id: str, names: TableNames) -> tuple[int, int]:
    """Replace the members by those of the batch; malformed lines of all batches are kept."""
    tables.remove_batch(spark, names.quarantined_members, batch_id)
    return _land(
        members, schemas.MEMBERS, ("bene_id",), batch_id, names.raw_members, names.quarantined_members, "overwrite"
    )


def _land(
    lines: DataFrame, declared: T.StructType, keys: tuple[str, ...], batch_id: str, table: str, malformed: str, mode: str
) -> tuple[int, int]:
    """Write the usable lines; malformed ones, if any, are added to the quarantine table.

    Malformed lines are counted while the others land, so the files are read again only if
    there are some.
    """
    counted, seen = lines, None
    if schemas.CORRUPT in lines.columns:
        seen = Observation()
        counted = lines.observe(seen, F.count(schemas.CORRUPT).alias("malformed"))
    tagged = tag_null_keys(quarantine(counted)[0], keys)
    rows = tables.write_layer_table(add_audit_columns(tagged, "bronze", batch_id), table, mode, merge_schema=mode == "append")
    if seen is None:
        return rows, 0
    # the parser drops columns that nothing asks for, and then finds nothing wrong
    bad = quarantine(lines)[1].withColumn("_parsed", F.to_json(F.struct(*declared.names)))
    bad_rows = tables.observed(seen, "malformed")
    if bad_rows is None:  # no usable line at all
        bad_rows = bad.agg(F.count("_parsed")).first()[0]
    if bad_rows:
        rows_kept = add_audit_columns(bad.select(schemas.CORRUPT, "_parsed"), "bronze", batch_id)
        tables.write_table(rows_kept, malformed, "append")
    return rows, bad_rows


def run_silver(spark: SparkSession, params: Params, names: TableNames = TableNames(), batch_id: str | None = None) -> dict:
    """Build Silver anew from all landed batches."""
    batch_id = batch_id or new_batch_id()

    def write(df: DataFrame, name: str) -> int:
        return tables.write_layer_table(add_audit_columns(df, "silver", batch_id), name)

    batches = tables.landed_batches(spark, names.raw_claims)
    clean_rows = write(silver.clean_claims(_raw_claims(spark, names, batches), params), names.clean_claims)
    mapped_rows = write(silver.mapped_claims(_data(spark, names.clean_claims)), names.mapped_claims)
    member_rows = write(silver.member_profile(_data(spark, names.raw_members), params), names.member_profile)
    done = tables.landed_batches(spark, names.clean_claims) or []
    tables.record_batches(spark, names.clean_claims, [b for b in batches or [] if b not in done])
    return {
        "clean_claims_rows": clean_rows,
        "hcc_mapped_rows": mapped_rows,
        "member_profile_rows": member_rows,
    }


def _raw_claims(spark: SparkSession, names: TableNames, batches: list[str] | None) -> DataFrame:
    raw = tables.read_table(spark, names.raw_claims)
    return (raw if batches is None else raw.filter(F.col("_batch_id").isin(batches))).drop(*AUDIT)


def refresh_silver(
    spark: SparkSession, params: Params, names: TableNames = TableNames(), batch_id: str | None = None
) -> dict:
    """Bring Silver up to date with the batches that landed since its last run.

    The new lines are weighed against the cleaned lines of their service months, and only the
    partitions of these months are read and replaced, in the cleaned and in the mapped claims.
    The tables are then what ``run_silver`` over all batches would give, with one reservation:
    lines of other months keep the flags of the day they were judged, unless
    ``Params.as_of`` fixes the day. A run that fails is repeated from the same batches.
    """
    batch_id = batch_id or new_batch_id()
    landed, done = (tables.landed_batches(spark, n) for n in (names.raw_claims, names.clean_claims))
    if landed is None or done is None:
        return run_silver(spark, params, names, batch_id) | {"batches": landed or []}
    pending = [b for b in landed if b not in set(done)]
    members = add_audit_columns(silver.member_profile(_data(spark, names.raw_members), params), "silver", batch_id)
    result = {"member_profile_rows": tables.write_layer_table(members, names.member_profile), "batches": pending}
    if not pending:
        return result | {"clean_claims_rows": 0, "hcc_mapped_rows": 0, "months": 0}
    arrived = _raw_claims(spark, names, pending)
    months = silver.service_months(arrived).collect()  # bounded by the calendar
    if not months:
        tables.record_batches(spark, names.clean_claims, pending)
        return result | {"clean_claims_rows": 0, "hcc_mapped_rows": 0, "months": 0}
    touched = tables.in_partitions(tables.PARTITIONS["clean_claims"], months)

    def refresh(df: DataFrame, name: str) -> int:
        return tables.refresh_partitions(spark, name, add_audit_columns(df, "silver", batch_id), months)

    former = _data(spark, names.clean_claims).filter(touched)
    result["clean_claims_rows"] = refresh(silver.refreshed_claims(former, arrived, params), names.clean_claims)
    mapped = silver.mapped_claims(_data(spark, names.clean_claims).filter(touched))
    result["hcc_mapped_rows"] = refresh(mapped, names.mapped_claims)
    tables.record_batches(spark, names.clean_claims, pending)
    return result | {"months": len(months)}


def run_gold(spark: SparkSession, params: Params, names: TableNames = TableNames(), batch_id: str | None = None) -> dict:
    batch_id = batch_id or new_batch_id()

    def write(df: DataFrame, name: str) -> int:
        return tables.write_layer_table(add_audit_columns(df, "gold", batch_id), name)

    clean = _data(spark, names.clean_claims)
    mapped = _data(spark, names.mapped_claims)
    profile = _data(spark, names.member_profile).drop("_bronze_null_flag")
    raf_rows = write(gold.member_raf_scores(profile, mapped, params), names.raf_scores)
    scores = _data(spark, names.raf_scores)
    util_rows = write(gold.utilization_summary(clean), names.utilization)
    trend_rows = write(gold.monthly_trends(clean, params), names.trends)
    feature_rows = write(gold.risk_feature_store(scores, clean), names.feature_store)
    tiers = tier_counts(scores).collect()  # at most one row per tier
    return {
        "raf_rows": raf_rows,
        "util_rows": util_rows,
        "trends_rows": trend_rows,
        "feature_rows": feature_rows,
        "mean_raf": tiers[0]["mean_raf"] if tiers else None,
        "tier_counts": {row["risk_tier"]: row["n_members"] for row in tiers},
    }


def run_all(
    spark: SparkSession,
    claims_path: str,
    members_path: str,
    params: Params,
    batch_id: str | None = None,
    names: TableNames = TableNames(),
) -> dict:
    batch_id = batch_id or new_batch_id()
    return {
        "bronze": run_bronze(spark, claims_path, members_path, batch_id, names),
        "silver": run_silver(spark, params, names, batch_id),
        "gold": run_gold(spark, params, names, batch_id),
    }


def table_rows(clean: DataFrame) -> DataFrame:
    """Rows of the tables that follow from the clean claims, without building them.

    Lines are counted per member, period, arm and month first; what is left is
    one row per such cell, from which every table's size can be read.
    """
    month = ("service_year", "service_month")
    cells = clean.groupBy("bene_id", "period", "intervention_arm", *month).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(QUALITY_PASS).alias("n_passing")
    )
    used = F.col("n_passing") > 0
    sizes = cells.agg(
        F.coalesce(F.sum("n_lines"), F.lit(0)).alias("clean_claims"),
        F.coalesce(F.sum("n_passing"), F.lit(0)).alias("hcc_mapped_claims"),
        F.count_distinct(F.when(used, F.struct("bene_id", "period", "intervention_arm"))).alias("utilization_summary"),
        F.count_distinct(F.when(used, F.struct(*month, "intervention_arm"))).alias("monthly_trends"),
    )
    return sizes.unpivot([], sizes.columns, "table_name", "n_rows")


def run_summary(**layers: DataFrame) -> DataFrame:
    """Rows per named table, as one frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in layers.items()
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first
