"""Named tables: layout, writes with row counts, guards and upserts.

Tables are Parquet tables of the session's catalog. Row counts come from an
observation of the write itself. Range layouts sample their input in a job of
its own; landing tables use a layout that reads it once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from claimlake.operators.merge import duplicate_keys, latest_snapshot, merge_upsert, read_as_of

# Directory columns and sort columns of each table.
PARTITIONS: dict[str, tuple[str, ...]] = {
    "raw_claims": ("claim_year", "claim_month"),
    "clean_claims": ("service_year", "service_month"),
    "hcc_mapped_claims": ("service_year", "service_month"),
    "utilization_summary": ("period",),
}
CLUSTERING: dict[str, tuple[str, ...]] = {
    "raw_claims": ("bene_id",),
    "clean_claims": ("bene_id",),
    "hcc_mapped_claims": ("bene_id", "hcc_burden_count"),
    "member_raf_scores": ("bene_id", "risk_tier"),
    "risk_feature_store": ("risk_tier",),
}


#: Tables laid out by size per directory instead of by ranges, so their input is read once.
LANDED = ("raw_claims",)
#: Table property that marks a table as append-only, so that its past can be read.
HISTORY = "claimlake.history"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now: files that other sessions wrote or replaced are listed anew."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_version(
    spark: SparkSession, name: str, version: int | None = None, timestamp: str | None = None
) -> DataFrame:
    """A table as it stood earlier; a version wins over a timestamp.

    Snapshot tables give their newest snapshot by then, append-only tables
    the batches up to then. Other tables keep no history, which is an error.
    """
    table = spark.table(name)
    if "_snapshot" in table.columns:
        return latest_snapshot(table, version, timestamp)
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if properties.get(HISTORY) != "append":
        raise ValueError(f"{name} is overwritten as a whole and keeps no earlier versions")
    return read_as_of(table, version, timestamp)


def landed(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Rows of a directory together, in files of the advised size, sorted inside.

    The rebalancing shuffle merges small directories' rows and splits large
    ones by measured size, without sampling the input first.
    """
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *cluster_by)


def clustered(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
    """Lay rows out for the write: few files per directory, sorted inside.

    Range partitioning on directory and cluster columns gives each task a
    contiguous stretch, so Parquet min/max statistics can skip row groups. A
    hash of the row as last range column lets a key that holds many rows
    spread over several tasks.
    """
    columns = [*partition_by, *cluster_by]
    if not columns:
        return df
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(*[F.col(c) for c in columns], spread).sortWithinPartitions(*columns)


def observed(seen: Observation, name: str) -> int | None:
    """A number observed during a write; None where the optimizer left the observed part out."""
    try:
        return int(seen.get[name])
    except Py4JJavaError:
        return None


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    merge_schema: bool = False,
    by_ranges: bool = True,
) -> int:
    """Write a table and return the number of rows written.

    ``merge_schema`` lets an append bring columns the table lacks, and fills
    columns the rows lack with NULL.
    """
    spark = df.sparkSession
    seen = Observation()
    if mode == "append" and table_exists(spark, name):
        table = spark.table(name)
        added = [f for f in df.schema.fields if f.name not in table.columns]
        if added and not merge_schema:
            raise ValueError(f"{name} lacks columns {[f.name for f in added]}; pass merge_schema=True")
        for f in added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")
        types = {f.name: f.dataType for f in spark.table(name).schema.fields}
        absent = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
        if absent and not merge_schema:
            raise ValueError(f"Rows lack columns {list(absent)} of {name}; pass merge_schema=True")
        df = df.withColumns(absent).select(*types)
    new = not table_exists(spark, name)
    layout = clustered if by_ranges or not partition_by else landed
    laid_out = layout(df, partition_by, cluster_by).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = laid_out.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    if mode == "append" and new:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{HISTORY}' = 'append')")
    return observed(seen, "rows") or 0


def write_layer_table(df: DataFrame, name: str, mode: str = "overwrite", merge_schema: bool = False) -> int:
    """``write_table`` with the layout declared for the table's short name."""
    short = name.rsplit(".", 1)[-1]
    return write_table(
        df, name, mode, PARTITIONS.get(short, ()), CLUSTERING.get(short, ()), merge_schema, short not in LANDED
    )


def write_snapshot(df: DataFrame, name: str, version: int) -> int:
    """Add a whole new snapshot of a table; earlier ones stay readable by version and time."""
    rows = df.withColumn("_snapshot", F.lit(version))
    if "_ingested_at" not in rows.columns:
        rows = rows.withColumn("_ingested_at", F.current_timestamp())
    return write_table(rows, name, "append", ["_snapshot"])


def replace_partitions(df: DataFrame, name: str) -> None:
    """Overwrite only the partitions of a table that occur in ``df``.

    The mode is an option of this write, so other writers of the session keep theirs.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns).write.option("partitionOverwriteMode", "dynamic")
    rows.partitionBy(*partition_columns(spark, name)).mode("overwrite").parquet(_location(spark, name))
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


# --- batches ----------------------------------------------------------------

STARTED_BATCH, LANDED_BATCH = "started", "landed"


def ledger_name(name: str) -> str:
    return f"{name}__batches"


def record_batches(
    spark: SparkSession, name: str, batch_ids: Sequence[str], rows: int | None = None, status: str = LANDED_BATCH
) -> None:
    """Note in the table's ledger that batches are being written, or have landed."""
    if not batch_ids:
        return
    entries = spark.createDataFrame([(b,) for b in batch_ids], "_batch_id string").coalesce(1)
    noted = entries.withColumns(
        {"n_rows": F.lit(rows).cast("bigint"), "noted_at": F.current_timestamp(), "status": F.lit(status)}
    )
    noted.write.format("parquet").mode("append").saveAsTable(ledger_name(name))


def record_batch(spark: SparkSession, name: str, batch_id: str, rows: int | None, status: str = LANDED_BATCH) -> None:
    record_batches(spark, name, [batch_id], rows, status)


def landed_batches(spark: SparkSession, name: str) -> list[str] | None:
    """The batches whose rows are all there, by the ledger; None for a table without one."""
    ledger = batch_ledger(spark, name)
    if ledger is None:
        return None
    return [r["_batch_id"] for r in ledger.filter(F.col("status") == LANDED_BATCH).orderBy("_batch_id").collect()]


def batch_ledger(spark: SparkSession, name: str) -> DataFrame | None:
    """One row per batch of a table, ``status`` the furthest it came; None without a ledger."""
    if not table_exists(spark, ledger_name(name)):
        return None
    notes = read_table(spark, ledger_name(name))
    landed = F.max(F.col("status") == LANDED_BATCH)
    return notes.groupBy("_batch_id").agg(
        F.max("n_rows").alias("n_rows"), F.when(landed, LANDED_BATCH).otherwise(STARTED_BATCH).alias("status")
    )


def batch_status(spark: SparkSession, name: str, batch_id: str) -> str | None:
    """How far a batch came, by the ledger or, for a table that has none, by its rows."""
    ledger = batch_ledger(spark, name)
    if ledger is not None:
        found = ledger.filter(F.col("_batch_id") == batch_id).select("status").first()
        return found["status"] if found else None
    if not table_exists(spark, name):
        return None
    there = not spark.table(name).filter(F.col("_batch_id") == batch_id).limit(1).isEmpty()
    return LANDED_BATCH if there else None


def batch_already_ingested(spark: SparkSession, name: str, batch_id: str) -> bool:
    return batch_status(spark, name, batch_id) == LANDED_BATCH


def remove_batch(spark: SparkSession, name: str, batch_id: str) -> None:
    """Take out what an unfinished write of a batch left behind; only its partitions are rewritten."""
    if not table_exists(spark, name):
        return
    table, parts = read_table(spark, name), partition_columns(spark, name)
    left = table.filter(F.col("_batch_id") == batch_id)
    if left.limit(1).isEmpty():
        return
    others = table.filter(~F.col("_batch_id").eqNullSafe(F.lit(batch_id)))
    if not parts:
        _switch_folder(spark, name, others)
        return
    touched = left.select(*parts).distinct().collect()  # partitions, not rows
    refresh_partitions(spark, name, others.filter(in_partitions(parts, touched)), touched)


def in_partitions(parts: Sequence[str], rows: Sequence[Row]) -> Column:
    """Whether a row lies in one of the listed partitions; reaches the scan as a partition filter."""
    listed = F.lit(False)
    for row in rows:
        same = F.lit(True)
        for part in parts:
            same = same & F.col(part).eqNullSafe(F.lit(row[part]))
        listed = listed | same
    return listed


def refresh_partitions(spark: SparkSession, name: str, rows: DataFrame, touched: Sequence[Row]) -> int:
    """Replace the listed partitions by ``rows``, which may be read from the table itself.

    New files are complete before old ones go. A listed partition that gets no rows is dropped.
    Returns the number of rows written.
    """
    parts = partition_columns(spark, name)
    staging = f"{name}__staging_{uuid.uuid4().hex}"
    short = name.rsplit(".", 1)[-1]
    written = write_table(rows, staging, partition_by=parts, cluster_by=CLUSTERING.get(short, ()))
    filled = {tuple(r) for r in spark.table(staging).select(*parts).distinct().collect()}
    if filled:
        replace_partitions(spark.table(staging), name)
    for row in touched:
        if tuple(row[p] for p in parts) not in filled:
            values = ", ".join(f"`{p}` = {_sql_literal(row[p])}" for p in parts)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({values})")
    spark.sql(f"DROP TABLE {staging}")
    spark.catalog.refreshTable(name)
    return written


def upsert_table(spark: SparkSession, updates: DataFrame, name: str, keys: Sequence[str]) -> int:
    """Merge updates into a table, creating it if absent; returns its new size.

    A partitioned table keeps its partitions: only those that hold a matched
    key or receive an update are rewritten, each replaced when its new files are
    complete. Another table gets a new folder, to which it is switched in one
    step, so it can be read at any time. Updates that repeat a key are refused.
    """
    if not duplicate_keys(updates, keys).isEmpty():
        raise ValueError(f"Updates repeat a key over {list(keys)}")
    if not table_exists(spark, name):
        return write_layer_table(updates, name)
    target, parts = spark.table(name), partition_columns(spark, name)
    columns = target.columns
    extra = [c for c in updates.columns if c not in columns]
    if extra:
        raise ValueError(f"{name} lacks columns {extra}")
    if not parts:
        return _switch_folder(spark, name, merge_upsert(target, updates, keys).select(*columns))
    matched = target.join(updates.select(*keys), list(keys), "left_semi").select(*parts)
    touched = matched.unionByName(updates.select(*parts)).distinct().collect()  # partitions, not rows
    old = target.filter(in_partitions(parts, touched))
    refresh_partitions(spark, name, merge_upsert(old, updates, keys).select(*columns), touched)
    return spark.table(name).count()


def _sql_literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location").rstrip("/")


def _switch_folder(spark: SparkSession, name: str, rows: DataFrame) -> int:
    """Write rows to a new folder beside the table's and point the table to it."""
    short = name.rsplit(".", 1)[-1]
    new = f"{_location(spark, name).rsplit('/', 1)[0]}/{short}-{uuid.uuid4().hex}"
    clustered(rows, (), CLUSTERING.get(short, ())).write.parquet(new)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    return spark.table(name).count()
