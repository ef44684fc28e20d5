"""Claim lines: typing, deduplication, quality rules, derived features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.codes import TIE_COLUMNS
from claimlake.functions import expressions as X
from claimlake.operators.validation import BRONZE_NULL
from claimlake.params import Params

AMOUNTS = ("claim_amount", "allowed_amount", "paid_amount")


def cast_claims(df: DataFrame, keep_given_month: bool = False) -> DataFrame:
    """Type the date and amounts; anything unreadable becomes NULL.

    Year and month follow the service date. With ``keep_given_month`` a year
    or month that came with the claim wins and the date only fills gaps.
    """
    # a column that is a double already keeps its name for the planner, so equal shuffles stay equal
    kinds = dict(df.dtypes)
    amounts = {a: F.col(a).try_cast("double") for a in AMOUNTS if kinds.get(a, "double") != "double"}
    typed = df.withColumns({"service_date": X.iso_date("service_date"), **amounts})
    year, month = F.year("service_date"), F.month("service_date")
    if keep_given_month:
        year, month = F.coalesce("claim_year", year), F.coalesce("claim_month", month)
    return typed.withColumns({"claim_year": year, "claim_month": month})


def dedup_keep_best(
    df: DataFrame,
    keys: Sequence[str],
    best: str = "paid_amount",
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the largest ``best`` value per key.

    NULL keys are equal to each other and a NULL ``best`` loses. Ties go by
    ``tie_breakers``, by default every other column the frame has (claim
    amount first). To drop columns and still keep the same row, order by
    ``tie_digest``, taken before. Each map task keeps only its own best row per key
    before the shuffle, so a key holding most rows does not make one large task.
    """
    if tie_breakers is None:
        rest = [c for c in df.columns if c not in (*keys, best)]
        tie_breakers = sorted(rest, key=lambda c: c != "claim_amount")
    order = [F.desc_nulls_last(c) for c in (best, *tie_breakers)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_best_with(kept: DataFrame, arrived: DataFrame, keys: Sequence[str], best: str, tie_breakers: Sequence[str]) -> DataFrame:
    """The best row per key of rows that are best already and rows that came since.

    The order of rows is total, so the best of a key's former best and its new rows is the
    best of all its rows: what was weighed once need not be read again.
    """
    both = kept.unionByName(arrived.select(*kept.columns))
    return dedup_keep_best(both, keys, best, tie_breakers)


def tie_digest(df: DataFrame) -> Column:
    """A digest of the text columns of a claim line, to order lines of equal amounts."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TIE_COLUMNS if c in df.columns]
    return F.substring(F.md5(F.concat_ws("|", *texts)), 1, 16)


def quality_rules(params: Params) -> dict[str, Column]:
    amount, date = F.col("claim_amount"), F.col("service_date")
    return {
        "flag_null_claim_id": F.col("claim_id").isNull(),
        "flag_null_bene_id": F.col("bene_id").isNull(),
        "flag_negative_amount": amount < 0,
        "flag_zero_amount": amount == 0,
        "flag_excessive_amount": amount > params.max_claim_amount,
        "flag_future_date": date > params.today(),
        "flag_null_service_date": date.isNull(),
        "flag_null_icd10": F.col("icd10_primary").isNull(),
        "flag_bronze_null": F.col(BRONZE_NULL),
    }


def flags(params: Params = Params()) -> tuple[str, ...]:
    return tuple(quality_rules(params))


def derive_features(df: DataFrame, params: Params) -> DataFrame:
    """Date parts, period, cost tier and, where there is a service type, its flags."""
    date = F.col("service_date")
    has_service = "service_type" in df.columns
    return df.withColumns(
        {
            "service_year": F.year(date),
            "service_month": F.month(date),
            "service_quarter": F.quarter(date),
            "day_of_week": F.dayofweek(date),
            "is_weekend": F.dayofweek(date).isin(1, 7),
            "period": X.period(F.year(date), params),
            **(X.service_flags(F.col("service_type")) if has_service else {}),
            "cost_tier": X.cost_tier(F.col("claim_amount"), params),
        }
    )


def volume_by_month(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("claim_year", "claim_month")
        .agg(
            F.count(F.lit(1)).alias("n_claims"),
            F.count_distinct("bene_id").alias("n_members"),
            X.exact_sum("claim_amount").alias("_total"),
            F.count("claim_amount").alias("_n_amounts"),
        )
        .select(
            "claim_year",
            "claim_month",
            "n_claims",
            "n_members",
            F.round("_total", 0).alias("total_cost_usd"),
            F.round(F.col("_total") / F.nullif(F.col("_n_amounts"), F.lit(0)), 2).alias("avg_claim_usd"),
        )
    )
