"""Shared-savings economics as columns over any cohort frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.codes import POPULATIONS
from claimlake.functions import expressions as X
from claimlake.params import Params


def with_savings(df: DataFrame, params: Params) -> DataFrame:
    """Add savings columns to rows of benchmark_pmpm, actual_pmpm and n_lives.

    ``sharing_rate`` and ``msr`` are taken from the row where it has them.
    Savings are shared only when the rate is above the minimum, not at it.
    """
    defaults = {"sharing_rate": params.sharing_rate, "msr": params.msr}
    rows = df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})
    lives = F.col("n_lives")
    expected = F.col("benchmark_pmpm") * lives * 12
    spent = F.col("actual_pmpm") * lives * 12
    return (
        rows.withColumn("gross_savings", expected - spent)
        .withColumn("savings_rate", F.col("gross_savings") / F.greatest(expected, F.lit(1.0)))
        .withColumn("exceeds_msr", F.col("savings_rate") > F.col("msr"))
        .withColumn(
            "earned_savings",
            F.when(F.col("exceeds_msr"), F.col("gross_savings") * F.col("sharing_rate")).otherwise(0.0),
        )
        .withColumns(
            {
                "per_member_gross": F.col("gross_savings") / F.greatest(lives, F.lit(1)),
                "per_member_earned": F.col("earned_savings") / F.greatest(lives, F.lit(1)),
                "status": F.when(F.col("exceeds_msr"), "SAVINGS_EARNED").otherwise("BELOW_MSR"),
            }
        )
    )


def savings_from_att(df: DataFrame, params: Params, att: str = "att_annual_savings") -> DataFrame:
    """Savings of rows holding an annual saving per member (positive = saved)."""
    actual = F.lit(params.benchmark_pmpm) - F.col(att) / 12
    rows = df.withColumns({"benchmark_pmpm": F.lit(params.benchmark_pmpm), "actual_pmpm": actual})
    return with_savings(rows, params)


def project(
    effect: DataFrame,
    params: Params,
    populations: Sequence[tuple[str, int]] = POPULATIONS,
    att: str = "att_annual_savings",
) -> DataFrame:
    """Savings of each effect row at each population size.

    Scenarios are a literal array expanded per row, so no join is needed.
    """
    cells = [F.struct(F.lit(name).alias("scenario"), F.lit(n).alias("n_lives")) for name, n in populations]
    return savings_from_att(effect.select("*", F.inline(F.array(*cells))), params, att)


def override_grid(
    df: DataFrame, sharing_rates: Sequence[float], msrs: Sequence[float], params: Params
) -> DataFrame:
    """Savings of each row under every sharing rate and minimum rate given."""
    pairs = [
        F.struct(F.lit(float(s)).alias("sharing_rate"), F.lit(float(m)).alias("msr"))
        for s in sharing_rates
        for m in msrs
    ]
    return with_savings(df.select("*", F.inline(F.array(*pairs))), params)


def cohort_actuals(
    scores: DataFrame, params: Params, by: Sequence[str] = (), n_lives: int | None = None
) -> DataFrame:
    """Benchmark, mean actual PMPM and lives per cohort of scored members."""
    lives: Column = F.count("bene_id") if n_lives is None else F.lit(n_lives)
    return scores.groupBy(*by).agg(
        F.lit(params.benchmark_pmpm).alias("benchmark_pmpm"),
        F.coalesce(X.exact_mean("actual_pmpm"), F.lit(0.0)).alias("actual_pmpm"),
        lives.cast("bigint").alias("n_lives"),
    )


def savings_from_scores(
    scores: DataFrame, params: Params, by: Sequence[str] = (), n_lives: int | None = None
) -> DataFrame:
    return with_savings(cohort_actuals(scores, params, by, n_lives), params)


def scenario_frame(spark: SparkSession, rows: Sequence[tuple[float, float, int]]) -> DataFrame:
    """Hand-written cases as a frame for ``with_savings``."""
    return spark.createDataFrame(rows, "benchmark_pmpm double, actual_pmpm double, n_lives int")
