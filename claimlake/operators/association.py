"""Trends side by side, categories that occur together, features that move together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.functions import expressions as X


def parallel_trends(trends: DataFrame, outcome: str = "pmpm_cost") -> DataFrame:
    """Whether the arms moved in parallel before the cut-over: one row.

    The least-squares fit of the outcome on month, arm and month by arm splits into a line
    per arm, so count, centred squares and products per arm are all it needs: the
    interaction is the difference of the slopes, its error follows from the pooled residuals.
    NULL where an arm has fewer than two months, or no residual is left to judge by.
    """
    month = X.month_index(F.col("service_year"), F.col("service_month"))
    before = trends.filter((F.col("period") == X.PRE) & F.col(outcome).isNotNull())

    def of(arm: int, measure) -> Column:
        inside = F.col("intervention_arm") == arm
        return measure(F.when(inside, F.col(outcome)), F.when(inside, month))

    parts = {}
    for name, arm in (("control", 0), ("treated", 1)):
        parts |= {
            f"n_{name}": of(arm, F.regr_count),
            f"_sxx_{name}": of(arm, F.regr_sxx),
            f"_sxy_{name}": of(arm, F.regr_sxy),
            f"_syy_{name}": of(arm, F.regr_syy),
        }
    sums = before.agg(*[column.alias(name) for name, column in parts.items()])

    def slope(name: str) -> Column:
        return F.col(f"_sxy_{name}") / F.nullif(F.col(f"_sxx_{name}"), F.lit(0.0))

    def residual(name: str) -> Column:
        return F.greatest(F.col(f"_syy_{name}") - slope(name) * F.col(f"_sxy_{name}"), F.lit(0.0))

    freedom = F.col("n_control") + F.col("n_treated") - 4
    variance = (residual("control") + residual("treated")) / F.when(freedom > 0, freedom)
    error = F.sqrt(variance * (1 / F.nullif(F.col("_sxx_control"), F.lit(0.0)) + 1 / F.nullif(F.col("_sxx_treated"), F.lit(0.0))))
    fitted = sums.select(
        "n_control", "n_treated", slope("control").alias("slope_control"), slope("treated").alias("slope_treated"),
        (slope("treated") - slope("control")).alias("interaction"), error.alias("standard_error"),
        F.when(freedom > 0, freedom).alias("degrees_of_freedom"),
    )
    return fitted.withColumn("t_value", F.col("interaction") / F.nullif(F.col("standard_error"), F.lit(0.0)))


def event_study(trends: DataFrame, outcome: str = "pmpm_cost") -> DataFrame:
    """Treated less control per month, against the last month before the cut-over.

    ``event_month`` counts months from the first after the cut-over, so the reference is the
    latest negative one with both arms. Rows are bounded by the calendar.
    """
    month = X.month_index(F.col("service_year"), F.col("service_month"))

    def of(arm: int) -> Column:
        return F.max(F.when(F.col("intervention_arm") == arm, F.col(outcome)))

    monthly = trends.groupBy("service_year", "service_month", "period").agg(
        (of(1) - of(0)).alias("difference"), F.max(month).alias("_month")
    )
    everything = Window.partitionBy()
    start = F.min(F.when(F.col("period") == X.POST, F.col("_month"))).over(everything)
    usable = (F.col("period") == X.PRE) & F.col("difference").isNotNull()
    reference = F.max_by(F.when(usable, F.col("difference")), F.when(usable, F.col("_month"))).over(everything)
    return monthly.select(
        "service_year", "service_month", "period", (F.col("_month") - start).alias("event_month"), "difference",
        (F.col("difference") - reference).alias("effect"),
    )


def co_occurrence(mapped: DataFrame, key: str = "bene_id", items: str = "hcc_list", min_support: float = 0.01) -> DataFrame:
    """Pairs of categories that the same members have, with support, confidence and lift.

    A member's categories are a set, bounded by the category list. Categories below the least
    support leave the sets before pairs are made, since no pair can have more support than
    either. Pairs are counted in every task first, so a category that most members have
    is a few rows of the shuffle.
    """
    sets = mapped.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(items)))).alias("items"))
    singles = sets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    members = sets.agg(F.count(F.lit(1)))
    kept = singles.withColumn("n_members", members.scalar()).filter(F.col("n") >= min_support * F.col("n_members"))
    frequent = kept.agg(F.array_sort(F.collect_list("item")))  # no longer than the category list
    pruned = sets.withColumn("frequent", frequent.scalar()).select(
        F.filter("items", lambda i: F.array_contains("frequent", i)).alias("items")
    )
    pairs = F.flatten(
        F.transform(
            "items",
            lambda a: F.transform(F.filter("items", lambda b: b > a), lambda b: F.struct(a.alias("item_a"), b.alias("item_b"))),
        )
    )
    counted = pruned.select(F.inline(pairs)).groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n_both"))
    a = kept.select(F.col("item").alias("item_a"), F.col("n").alias("n_a"), "n_members")
    b = kept.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    both, n = F.col("n_both"), F.col("n_members")
    return (
        counted.join(a, "item_a")
        .join(b, "item_b")
        .filter(both >= min_support * n)
        .select(
            "item_a", "item_b", "n_both", "n_a", "n_b", (both / n).alias("support"),
            (both / F.col("n_a")).alias("confidence_ab"), (both / F.col("n_b")).alias("confidence_ba"),
            (both * n / (F.col("n_a") * F.col("n_b"))).alias("lift"),
        )
    )


def correlations(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature_a, feature_b, n, correlation for every pair of features, in the order given.

    One scan and one aggregate: a row becomes its pairs of values, and every pair of features
    keeps running means and centred products, which merge across tasks, so what is
    shuffled is a matrix per task. NULL where a feature does not vary.
    """
    values = F.array(*[F.col(f).cast("double") for f in features])
    firsts = matrix.select(values.alias("x")).select("x", F.posexplode("x").alias("a", "value_a"))
    rest = F.slice("x", F.col("a") + 2, F.lit(len(features)))
    pairs = firsts.select("a", "value_a", F.posexplode(rest).alias("after", "value_b"))
    moments = pairs.groupBy("a", (F.col("a") + 1 + F.col("after")).alias("b")).agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_pop("value_a", "value_b").alias("covariance"),
        F.sqrt(F.var_pop("value_a")).alias("spread_a"),
        F.sqrt(F.var_pop("value_b")).alias("spread_b"),
    )
    names = F.array(*[F.lit(f) for f in features])
    return moments.select(
        F.get(names, F.col("a")).alias("feature_a"), F.get(names, F.col("b")).alias("feature_b"), "n",
        (F.col("covariance") / F.nullif(F.col("spread_a"), F.lit(0.0)) / F.nullif(F.col("spread_b"), F.lit(0.0))).alias("correlation"),
    )
