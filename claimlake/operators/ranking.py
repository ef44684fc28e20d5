"""Exact ranks and quantiles without sorting a whole group in one task.

Values are first counted per distinct value. Each value then has a coarse and
a fine bucket number, taken from the exponent and leading bits of the double,
both in value order. Running totals go over coarse buckets, then over the fine
buckets of a coarse one, then over the values of a fine one. However the
values are distributed, each of these runs is over at most a few million rows
(2**12 coarse buckets per power of two, 2**20 fine buckets per coarse one,
2**20 doubles per fine one), so no key can make a task grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE_PER_OCTAVE = 2**12
FINE_PER_COARSE = 2**20


def value_buckets(value: Column) -> tuple[Column, Column]:
    """Coarse and fine bucket number of a double, in value order.

    Scaling by powers of two is exact, so are the numbers. Should the
    logarithm land on the wrong side of a power of two, the numbering carries
    on across it and names the same bucket. NULL has a bucket before all others:
    a number that is never NULL lets joins on it read one shuffle of the values.
    """
    size = F.abs(value)
    exponent = F.least(F.floor(F.log2(size)), F.lit(1024))
    scaled = (size / F.pow(F.lit(2.0), exponent) - 1) * COARSE_PER_OCTAVE
    coarse = (exponent + 1100) * COARSE_PER_OCTAVE + F.floor(scaled)
    fine = F.floor((scaled - F.floor(scaled)) * FINE_PER_COARSE)

    def signed(number: Column) -> Column:
        ordered = F.when(value == 0, F.lit(0)).when(value > 0, number).otherwise(-number).cast("bigint")
        return F.coalesce(ordered, F.lit(-(2**63)))

    return signed(coarse), signed(fine)


def count_values(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows per group and distinct value, as column ``n``; NULLs left out."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_before(
    counts: DataFrame, group: Sequence[str], value: str, weight: str, out: str, keep: Column | None = None
) -> DataFrame:
    """Add ``out``: the total ``weight`` of the smaller values of the group.

    ``out``_all is the weight of the whole group. ``counts`` holds one row per
    group and value. ``keep`` may restrict the work to stretches of interest;
    it may use ``_before``, ``_total`` and ``_all`` (weight before and in the
    stretch, and of the group).
    """
    coarse, fine = value_buckets(F.col(value))
    bucketed = counts.withColumns({"_coarse": coarse, "_fine": fine})

    def kept(df: DataFrame) -> DataFrame:
        return df if keep is None else df.filter(keep)

    cells = bucketed.groupBy(*group, "_coarse", "_fine").agg(F.sum(weight).alias("_cell"))
    over_coarse = Window.partitionBy(*group).orderBy("_coarse")
    stretches = kept(
        cells.groupBy(*group, "_coarse")
        .agg(F.sum("_cell").alias("_total"))
        .withColumns(
            {
                "_before": F.sum("_total").over(over_coarse) - F.col("_total"),
                "_all": F.sum("_total").over(Window.partitionBy(*group)),
            }
        )
    )
    over_fine = Window.partitionBy(*group, "_coarse").orderBy("_fine")
    offsets = kept(
        cells.join(stretches.drop("_total"), [*group, "_coarse"])
        .withColumn("_before", F.col("_before") + F.sum("_cell").over(over_fine) - F.col("_cell"))
        .withColumnRenamed("_cell", "_total")
    )
    over_values = Window.partitionBy(*group, "_coarse", "_fine").orderBy(value)
    return (
        bucketed.filter(F.col(value).isNotNull())
        .join(offsets, [*group, "_coarse", "_fine"])
        .withColumn(out, F.col("_before") + F.sum(weight).over(over_values) - F.col(weight))
        .drop("_coarse", "_fine", "_total", "_before")
        .withColumnRenamed("_all", f"{out}_all")
    )


def exact_quantiles(
    counts: DataFrame, group: Sequence[str], value: str, weight: str, probabilities: Sequence[float]
) -> DataFrame:
    """Linearly interpolated quantiles per group, as array ``quantiles``.

    ``counts`` holds one row per group and value and is read more than once.
    Only buckets that hold a wanted rank are ordered inside.
    """
    steps = F.array(*[F.lit(float(p)) for p in probabilities])

    def wanted(n: Column) -> Column:
        """Positions 0.. n-1 of each probability, whole part and the next."""
        spots = F.transform(steps, lambda p, i: F.struct(i.alias("step"), ((n - 1) * p).alias("spot")))
        return F.flatten(
            F.transform(
                spots,
                lambda s: F.array(
                    F.struct(s["step"].alias("step"), s["spot"].alias("spot"), F.floor(s["spot"]).alias("rank")),
                    F.struct(s["step"].alias("step"), s["spot"].alias("spot"), F.ceil(s["spot"]).alias("rank")),
                ),
            )
        )

    def inside(start: str, length: str):
        return lambda t: (F.col(start) <= t["rank"]) & (t["rank"] < F.col(start) + F.col(length))

    present = counts.filter(F.col(weight) > 0).select(*group, value, weight)
    useful = F.exists(wanted(F.col("_all")), inside("_before", "_total"))
    ranked = running_before(present, group, value, weight, "_start", keep=useful)
    hits = ranked.select(
        *group,
        F.col(value).alias("_value"),
        F.inline(F.filter(wanted(F.col("_start_all")), inside("_start", weight))),
    )
    lo, hi = F.min("_value"), F.max("_value")
    fraction = F.first("spot") - F.floor(F.first("spot"))
    per_step = hits.groupBy(*group, "step").agg((lo + (hi - lo) * fraction).alias("_quantile"))
    return per_step.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("step", "_quantile"))).alias("_steps")
    ).select(*group, F.col("_steps._quantile").alias("quantiles"))
