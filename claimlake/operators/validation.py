"""Schema checks, null profiles, audit columns and quality flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUALITY_PASS = "_quality_pass"
BRONZE_NULL = "_bronze_null_flag"


@dataclass(frozen=True)
class Difference:
    """A declared column that a frame lacks (no type found) or has in another type."""

    column: str
    declared: T.DataType
    found: T.DataType | None

    def __str__(self) -> str:
        there = "is absent" if self.found is None else f"is {self.found.simpleString()}"
        return f"{self.column} {there}, declared {self.declared.simpleString()}"


def schema_differences(df: DataFrame, declared: T.StructType) -> list[Difference]:
    """Where a frame falls short of a schema; more columns and nullability do not count."""
    found = {f.name: f.dataType for f in df.schema}
    pairs = [(f, found.get(f.name)) for f in declared]
    return [Difference(f.name, f.dataType, kind) for f, kind in pairs if kind != f.dataType]


def require_schema(df: DataFrame, declared: T.StructType) -> None:
    if differences := schema_differences(df, declared):
        raise ValueError("; ".join(map(str, differences)))


def schema_issues(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Schema differences as rows, with how many rows of ``df`` each one touches.

    A missing column touches every row; a wrong type touches the rows whose
    value does not survive a cast to the declared type.
    """

    def entry(d: Difference) -> Column:
        if d.found is None:
            kind, touched = "MISSING", F.count(F.lit(1))
        else:
            value = F.col(d.column)
            kind, touched = "TYPE MISMATCH", F.count_if(value.try_cast(d.declared).isNull() & value.isNotNull())
        return F.struct(F.lit(d.column).alias("column_name"), F.lit(kind).alias("issue"), touched.alias("n_rows"))

    entries = [entry(d) for d in schema_differences(df, declared)]
    if not entries:
        return df.sparkSession.createDataFrame([], "column_name string, issue string, n_rows bigint")
    return df.agg(F.array(*entries).alias("issues")).select(F.inline("issues"))


def add_audit_columns(df: DataFrame, layer: str, batch_id: str, ingested_at: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "_pipeline_layer": F.lit(layer),
            "_batch_id": F.lit(batch_id),
        }
    )


def tag_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_bronze_null_flag``: any of the key columns is null."""
    return df.withColumn(BRONZE_NULL, reduce(or_, [F.col(k).isNull() for k in keys]))


def count_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the null count of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``count_nulls`` in long form: one row per column."""
    names = list(columns or df.columns)
    return count_nulls(df, names).unpivot([], names, "column_name", "n_null")


def flag_quality_issues(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add one boolean per rule and ``_quality_pass``.

    ``_quality_pass`` is three-valued: it is NULL where no rule fires but a
    rule could not be decided.
    """
    flags = [F.col(name) for name in rules]
    return df.withColumns(dict(rules)).withColumn(QUALITY_PASS, ~reduce(or_, flags))


def quality_summary(df: DataFrame) -> DataFrame:
    verdict = F.col(QUALITY_PASS)
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(verdict).alias("n_pass"),
        F.count_if(~verdict).alias("n_fail"),
        F.count_if(verdict.isNull()).alias("n_unknown"),
    )


def flag_breakdown(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(F.col(f).cast("int")).alias(f) for f in flags])


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
