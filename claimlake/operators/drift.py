"""Population-stability drift between two snapshots, all features at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.codes import DRIFT_FEATURES
from claimlake.functions.clinical import values_frame
from claimlake.operators.ranking import exact_quantiles
from claimlake.params import Params

STABLE, WARNING, CRITICAL = "STABLE", "WARNING", "CRITICAL"


def shared_features(
    baseline: DataFrame, current: DataFrame, features: Sequence[str] = DRIFT_FEATURES
) -> list[str]:
    """The features both snapshots have; others are skipped."""
    return [f for f in features if f in baseline.columns and f in current.columns]


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [], list(features), "feature", "value"
    )


def value_counts(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows of each snapshot per feature and distinct value.

    Every later step reads this one aggregate, so a value shared by most
    members is a single row from here on; the shuffle below it is reused.
    """
    both = _long(baseline, features).withColumns({"b": F.lit(1), "c": F.lit(0)}).unionByName(
        _long(current, features).withColumns({"b": F.lit(0), "c": F.lit(1)})
    )
    # counted by side first: whichever sums a step reads, this shuffle is the same
    sides = (
        both.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value", "b", "c")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return sides.groupBy("feature", "value").agg(
        F.sum(F.col("b") * F.col("n")).alias("n_baseline"), F.sum(F.col("c") * F.col("n")).alias("n_current")
    )


def baseline_edges(counts: DataFrame, params: Params) -> DataFrame:
    """Distinct quantile edges of the baseline per feature, ascending."""
    steps = [i / params.psi_bins for i in range(params.psi_bins + 1)]
    quantiles = exact_quantiles(counts, ["feature"], "value", "n_baseline", steps)
    return quantiles.select("feature", F.array_distinct("quantiles").alias("edges"))


def _bin(value: Column, edges: Column, params: Params) -> Column:
    """1-based bin of a value: half-open bins, the last one closed.

    NULL outside the edges.
    """
    passed = [F.coalesce((value >= F.get(edges, F.lit(i))).cast("int"), F.lit(0)) for i in range(params.psi_bins + 1)]
    position = sum(passed[1:], passed[0])
    last = F.size(edges) - 1
    inside = (value >= F.get(edges, F.lit(0))) & (value <= F.get(edges, last))
    return F.when(inside, F.least(position, last))


def histogram(counts: DataFrame, edges: DataFrame, params: Params) -> DataFrame:
    """Rows of both snapshots per feature and bin, empty bins included.

    The edge table has one row per feature, so it is broadcast.
    """
    usable = edges.filter(F.size("edges") >= 2)
    binned = (
        counts.join(F.broadcast(usable), "feature")
        .withColumn("bin", _bin(F.col("value"), F.col("edges"), params))
        .filter(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.sum("n_baseline").alias("n_baseline"), F.sum("n_current").alias("n_current"))
    )
    every = usable.select(
        "feature", "edges", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("bin")
    ).select(
        "feature",
        "bin",
        F.get("edges", F.col("bin") - 1).alias("lower_edge"),
        F.get("edges", F.col("bin")).alias("upper_edge"),
    )
    return every.join(binned, ["feature", "bin"], "left").na.fill(0, ["n_baseline", "n_current"])


def classify(psi: Column, params: Params) -> Column:
    """A value exactly at a threshold belongs to the milder class."""
    return (
        F.when(psi > params.psi_critical, CRITICAL).when(psi > params.psi_warning, WARNING).otherwise(STABLE)
    )


def monitor_drift(
    baseline: DataFrame,
    current: DataFrame,
    params: Params,
    features: Sequence[str] = DRIFT_FEATURES,
) -> DataFrame:
    """One row per feature: stability index, status and non-null counts.

    Values outside the baseline edges fall out of the bins but stay in the
    denominator. A feature without two distinct edges, or without values on
    either side, scores 0.
    """
    names = shared_features(baseline, current, features)
    counts = value_counts(baseline, current, names)
    bins = histogram(counts, baseline_edges(counts, params), params)
    totals = counts.groupBy("feature").agg(
        F.sum("n_baseline").alias("total_baseline"), F.sum("n_current").alias("total_current")
    )

    def share(n: str, total: str) -> Column:
        ratio = F.col(n) / F.greatest(F.col(total), F.lit(1))
        return F.when(F.col(n) == 0, F.lit(params.psi_epsilon)).otherwise(ratio)

    expected, actual = share("n_baseline", "total_baseline"), share("n_current", "total_current")
    scored = (
        bins.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.round(F.sum((actual - expected) * F.log(actual / expected)), 4).alias("psi"))
    )
    listed = values_frame(baseline.sparkSession, "feature", [(f,) for f in names])
    empty = (F.col("n_baseline") == 0) | (F.col("n_current") == 0)
    report = (
        listed.join(totals, "feature", "left")
        .join(scored, "feature", "left")
        .select(
            "feature",
            F.coalesce("psi", F.lit(0.0)).alias("psi"),
            F.coalesce("total_baseline", F.lit(0)).cast("bigint").alias("n_baseline"),
            F.coalesce("total_current", F.lit(0)).cast("bigint").alias("n_current"),
        )
        .withColumn("psi", F.when(empty, F.lit(0.0)).otherwise(F.col("psi")))
    )
    return report.select(
        "feature", "psi", classify(F.col("psi"), params).alias("status"), "n_baseline", "n_current"
    ).orderBy(F.desc("psi"), "feature")


def report_overall(report: DataFrame) -> DataFrame:
    """One row over a drift report: worst status, alert counts, largest index."""
    critical = F.count_if(F.col("status") == CRITICAL)
    alerts = F.count_if(F.col("status") != STABLE)
    return report.agg(
        F.when(critical > 0, CRITICAL).when(alerts > 0, WARNING).otherwise(STABLE).alias("overall_status"),
        F.count(F.lit(1)).alias("n_features"),
        alerts.alias("n_alerts"),
        critical.alias("n_critical"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("status") != STABLE, F.col("feature")))), ",").alias(
            "alert_features"
        ),
    )
