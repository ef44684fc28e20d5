"""Batches, snapshots and upserts as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.claims import dedup_keep_best


def only_new_batches(incoming: DataFrame, ledger: DataFrame, batch: str = "_batch_id") -> DataFrame:
    """The incoming rows whose batch the ledger does not list yet.

    The ledger has a row per landed batch, so no landed data is read, and the
    planner sees its size. A NULL batch is never listed.
    """
    return incoming.join(ledger.select(batch), batch, "left_anti").select(*incoming.columns)


def version_order(df: DataFrame, column: str) -> Column:
    """A value that orders versions: numbers as numbers, also where they are text.

    Text is compared by length without leading zeros, then character by
    character. That is numeric order for digits and text order for ids of one width.
    """
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    digits = F.ltrim(F.col(column), F.lit("0"))
    return F.when(F.col(column).isNotNull(), F.struct(F.length(digits).alias("width"), digits.alias("text")))


def _given_order(df: DataFrame, column: str, version: str | int) -> Column:
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.lit(version)
    digits = str(version).lstrip("0")
    return F.struct(F.lit(len(digits)).alias("width"), F.lit(digits).alias("text"))


def read_as_of(
    table: DataFrame,
    version: str | int | None = None,
    timestamp: str | None = None,
    version_column: str = "_batch_id",
    timestamp_column: str = "_ingested_at",
) -> DataFrame:
    """An append-only table as it stood at a version or, failing that, a time."""
    if version is not None:
        return table.filter(version_order(table, version_column) <= _given_order(table, version_column, version))
    if timestamp is not None:
        return table.filter(F.col(timestamp_column) <= F.to_timestamp(F.lit(timestamp)))
    return table


def latest_snapshot(
    table: DataFrame,
    version: int | None = None,
    timestamp: str | None = None,
    version_column: str = "_snapshot",
    timestamp_column: str = "_ingested_at",
) -> DataFrame:
    """The newest whole snapshot not after a version or time.

    The wanted number is one row, so the join broadcasts and prunes the
    snapshot partitions that are read.
    """
    visible = read_as_of(table, version, timestamp, version_column, timestamp_column)
    newest = visible.agg(F.max(version_column).alias(version_column))
    return table.join(F.broadcast(newest), version_column, "left_semi").select(*table.columns)


def latest_per_key(table: DataFrame, keys: Sequence[str], version_column: str = "_batch_id") -> DataFrame:
    """The newest version of every key."""
    ordered = table.withColumn("_version", version_order(table, version_column))
    return dedup_keep_best(ordered, keys, best="_version").drop("_version")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    complete = df.filter(_all_present(keys))
    return complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _all_present(keys: Sequence[str]) -> Column:
    present = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        present = present & F.col(key).isNotNull()
    return present


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a match, followed by every update row.

    A matched row is replaced as a whole, an unmatched update is inserted,
    and a NULL key matches nothing. Updates must be unique per key; see
    ``duplicate_keys``. Only the keys of the updates take part in the join.
    """
    untouched = target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns)
    return untouched.unionByName(updates, allowMissingColumns=True)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both frames; a column that one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)
