"""Batch-idempotent landing of claim files as a stream.

The checkpoint records which files have been landed, so a restart or a
repeated run never lands a file twice; no batch-id probe is needed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.operators.validation import add_audit_columns, tag_null_keys
from claimlake.plans.pipeline import TableNames, land_claims
from claimlake.sources.schemas import CLAIMS, CORRUPT, with_corrupt


def checkpoint_dir(spark: SparkSession, name: str) -> str:
    """A folder for a stream's progress under the cluster's checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set; pass a checkpoint folder")
    return f"{base.rstrip('/')}/{name}"


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    table_path: str,
    batch_id: str,
    checkpoint: str | None = None,
    schema: T.StructType = CLAIMS,
    file_format: str = "csv",
) -> StreamingQuery:
    """Append the files that arrived since the last run, then stop."""
    reader = spark.readStream.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("columnNameOfCorruptRecord", CORRUPT).schema(with_corrupt(schema))
    else:
        reader = reader.schema(schema)
    rows = add_audit_columns(tag_null_keys(reader.load(landing), ("claim_id", "bene_id")), "bronze", batch_id)
    return (
        rows.withColumn("_source_file", F.input_file_name())
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint or checkpoint_dir(spark, "bronze_claims"))
        .partitionBy("claim_year", "claim_month")
        .trigger(availableNow=True)
        .start()
    )


def land_stream(
    spark: SparkSession,
    landing: str,
    checkpoint: str | None = None,
    names: TableNames = TableNames(),
    stream: str = "claims",
) -> StreamingQuery:
    """Land the claim files that arrived since the last run in the Bronze table, exactly once.

    Every micro-batch is a batch of the table's ledger, named by the stream and its number.
    A number is given again after a failure, with the same files, so a batch that had
    landed is skipped and one that had only started is taken out and landed again.
    Silver sees it when it is complete.
    """
    names.create_schemas(spark)
    lines = (
        spark.readStream.format("csv")
        .option("header", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(with_corrupt(CLAIMS))
        .load(landing)
    )
    return (
        lines.writeStream.foreachBatch(
            lambda batch, number: land_claims(batch.sparkSession, batch, f"{stream}-{number:012d}", names)
        )
        .option("checkpointLocation", checkpoint or checkpoint_dir(spark, f"bronze_{stream}"))
        .trigger(availableNow=True)
        .start()
    )
