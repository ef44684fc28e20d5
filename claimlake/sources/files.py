"""Landing files: CSV and Parquet readers, CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.sources.schemas import CORRUPT, with_corrupt


def read_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Read CSV with a header and a declared schema.

    A malformed line is kept, with its text in ``_corrupt_record``;
    ``strict`` makes the read fail on the first one instead.
    """
    reader = spark.read.option("header", True)
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    return (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(with_corrupt(schema))
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_auto(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Parquet for a ``.parquet`` path, otherwise CSV with the declared schema."""
    if path.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path)
    return read_csv(spark, path, schema, strict)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a permissive read into (usable rows, malformed rows)."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.option("header", True).mode(mode).csv(path)
