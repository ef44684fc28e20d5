"""Evaluation of tier and cost predictions, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.operators.ranking import running_before

ACTUAL, PREDICTED = "risk_tier", "predicted_tier"


def accuracy(df: DataFrame) -> DataFrame:
    hit = (F.col(ACTUAL) == F.col(PREDICTED)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(hit), 4).alias("tier_accuracy"))


def confusion(df: DataFrame) -> DataFrame:
    return df.groupBy(ACTUAL, PREDICTED).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted means.

    Works from the confusion counts. A ratio without cases is 0.
    """
    zero = F.lit(0).cast("bigint")
    n, hit = F.col("n"), F.col(ACTUAL) == F.col(PREDICTED)
    sides = F.array(
        F.struct(
            F.col(ACTUAL).alias("label"),
            n.alias("support"),
            zero.alias("claimed"),
            F.when(hit, n).otherwise(zero).alias("hits"),
        ),
        F.struct(F.col(PREDICTED).alias("label"), zero.alias("support"), n.alias("claimed"), zero.alias("hits")),
    )
    sums = (
        confusion(df)
        .select(F.inline(sides))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)

    per_class = sums.select(
        "label",
        ratio(F.col("hits"), F.col("claimed")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("claimed")).alias("f1_score"),
        "support",
    )
    measures = ("precision", "recall", "f1_score")
    support = F.sum("support").alias("support")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], support)
    weighted = per_class.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures], support
    )
    rows = per_class.unionByName(macro.withColumn("label", F.lit("macro avg"))).unionByName(
        weighted.withColumn("label", F.lit("weighted avg"))
    )
    return rows.select("label", *[F.round(m, 6).alias(m) for m in measures], "support")


def auc_one_vs_rest(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Area under the ROC curve of each class against the rest.

    The share of (class, rest) pairs that the score orders correctly, ties
    counting half. NULL for a class without cases on both sides.
    """
    long = df.select(
        F.col(ACTUAL), *[F.col(f"prob_{c}").cast("double").alias(c) for c in classes]
    ).unpivot([ACTUAL], list(classes), "class", "score")
    mine = (F.col(ACTUAL) == F.col("class")).cast("bigint")
    counts = long.groupBy("class", "score").agg(
        F.sum(mine).alias("n_pos"), F.sum(1 - mine).cast("double").alias("n_neg")
    )
    ranked = running_before(counts, ["class"], "score", "n_neg", "neg_below")
    pos, neg = F.col("n_pos"), F.col("n_neg")
    sums = ranked.groupBy("class").agg(
        F.sum(pos * (F.col("neg_below") + neg / 2)).alias("ordered"),
        F.sum(pos).alias("n_class"),
        F.sum(neg).cast("bigint").alias("n_rest"),
    )
    pairs = F.col("n_class").cast("double") * F.col("n_rest")
    return sums.select(
        "class", "n_class", "n_rest", F.round(F.col("ordered") / F.nullif(pairs, F.lit(0.0)), 6).alias("auc")
    )


def macro_auc(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Mean of the class areas, or NULL when one of them is undefined."""
    per_class = auc_one_vs_rest(df, classes)
    complete = F.count("auc") == len(classes)
    return per_class.agg(F.when(complete, F.round(F.avg("auc"), 4)).alias("auc_macro"))


def regression_metrics(
    df: DataFrame, actual: str = "estimated_annual_cost", predicted: str = "predicted_cost"
) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    spread = F.nullif(F.var_pop(actual), F.lit(0.0))
    return df.agg(
        F.round(F.avg(F.abs(error)), 2).alias("cost_mae"),
        F.round(F.sqrt(F.avg(error * error)), 2).alias("cost_rmse"),
        F.round(1 - F.avg(error * error) / spread, 4).alias("cost_r2"),
    )


def calibration_bins(df: DataFrame, confidence: str = "confidence", bins: int = 10) -> DataFrame:
    """Cases, accuracy and mean confidence per equal-width confidence bin."""
    hit = (F.col(ACTUAL) == F.col(PREDICTED)).cast("int")
    number = F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(hit).alias("accuracy"),
        F.avg(confidence).alias("mean_confidence"),
    )


def expected_calibration_error(df: DataFrame, confidence: str = "confidence", bins: int = 10) -> DataFrame:
    gap = F.abs(F.col("accuracy") - F.col("mean_confidence"))
    return calibration_bins(df, confidence, bins).agg(
        F.sum("n").alias("n"), F.round(F.sum(F.col("n") * gap) / F.sum("n"), 6).alias("ece")
    )
