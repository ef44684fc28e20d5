"""Claims and members expressed over the given order tables.

The views are deterministic column rules; they plant every kind of dirty row
that the quality checks look for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.codes import CROSSWALK
from claimlake.params import Params
from claimlake.sources import schemas

FIXTURE_PARAMS = Params(cutover_year=1998, as_of=dt.date(2001, 6, 30))

PLANS = ("HMO", "PPO", "PFFS", "SNP")
SPECIALTIES = ("01", "06", "11", "38", "78", "93", "99")
CODE_SLOTS = (*[row.icd10_code for row in CROSSWALK], "Z0000")

# Claims of this year or earlier form the first batch, later ones the second.
LAST_YEAR_OF_FIRST_BATCH = 1997


def _pick(values: tuple[str, ...], index: Column) -> Column:
    listed = F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")
    return F.get(listed, (index % len(values)).cast("int"))


def _null_every(n: int, key: Column, value: Column) -> Column:
    return F.when(key % n != 0, value)


def bene_id(custkey: str) -> Column:
    """Customer key as a member id of at least eight digits."""
    digits = F.col(custkey).cast("string")
    return F.concat(F.lit("BNE"), F.lpad(digits, F.greatest(F.length(digits), F.lit(8)), F.lit("0")))


def _arm(custkey: str) -> Column:
    return F.when(F.col(custkey) % 7 < 3, 1).otherwise(0)


def claims(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Raw claim lines; ``with_key`` keeps the line key ``_k`` the rules use.

    Lines and orders both grow with the data, so the join is a merge join at
    every size: the shuffle on the order key also spreads a single large file
    over all tasks, and the planner can split a skewed key.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # the next customer takes the lines of every 29th, so some members have no claims
    holder = F.when(F.col("o_custkey") % 29 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", holder.alias("o_custkey"))
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    mix = (F.col("l_partkey") * 31 + F.col("l_suppkey")) % 100
    customer, line = F.col("o_custkey"), F.col("l_linenumber")
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    shipped = F.col("l_shipdate").cast("date")

    columns = {
        "claim_id": _null_every(
            499, k, F.concat(F.lit("CLM"), F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"))
        ),
        "bene_id": _null_every(503, k, bene_id("o_custkey")),
        "service_date": F.when(k % 521 == 0, None)
        .when(k % 509 == 0, "bad-date")
        .otherwise(shipped.cast("string")),
        "claim_year": F.year(shipped),
        "claim_month": F.month(shipped),
        "service_type": F.when(mix < 8, "ip_admit")
        .when(mix < 20, "ed_visit")
        .when(mix < 45, "specialist")
        .when(mix < 85, "primary")
        .otherwise("lab"),
        "icd10_primary": _null_every(487, k, _pick(CODE_SLOTS, customer * 7)),
        "icd10_codes": _null_every(
            479,
            k,
            F.concat(
                _pick(CODE_SLOTS, customer * 7),
                F.lit("|"),
                F.lower(_pick(CODE_SLOTS, customer * 13 + line)),
                F.lit(" | "),
                _pick(CODE_SLOTS, customer * 29),
            ),
        ),
        "provider_specialty": _pick(SPECIALTIES, F.col("l_suppkey")),
        "claim_amount": F.when(k % 523 == 0, F.lit(0.0))
        .when(k % 541 == 0, -price / 10)
        .when(k % 547 == 0, price * 100)
        .when(k % 557 == 0, F.lit(None).cast("double"))
        .otherwise(price / 10),
        "allowed_amount": price / 10 * (1 - discount),
        "paid_amount": price / 10 * (1 - discount) * (1 - tax),
        "plan_type": _pick(PLANS, customer),
        "intervention_arm": _arm("o_custkey"),
    }
    assert list(columns) == schemas.CLAIMS.names
    extra = [k.alias("_k")] if with_key else []
    return joined.select(*[c.alias(name) for name, c in columns.items()], *extra)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    enrolled = F.date_add(F.lit(dt.date(1990, 1, 1)), (key % 1461).cast("int"))
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        bene_id("c_custkey").alias("bene_id"),
        F.when(key % 101 == 0, None)
        .when(key % 211 == 0, 130)
        .when(key % 223 == 0, -1)
        .otherwise((60 + key % 41).cast("int"))
        .alias("age"),
        F.when(key % 53 == 0, None).when(key % 2 == 0, "F").otherwise("M").alias("sex"),
        F.when(key % 5 == 0, 1).otherwise(0).alias("dual_eligible"),
        _pick(PLANS, key).alias("plan_type"),
        F.col("n_name").alias("state"),
        enrolled.cast("string").alias("enrollment_date"),
        _arm("c_custkey").alias("intervention_arm"),
    )


def _batch(number: str) -> Column:
    """A batch id read from the row, as from a table, not a constant to fold."""
    return F.when(F.col("claim_year").isNotNull(), number)


def first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims(spark, sf_dir).filter(F.col("claim_year") <= LAST_YEAR_OF_FIRST_BATCH)
    return rows.withColumn("_batch_id", _batch("1"))


def second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later claims plus a corrected re-send of one in ten of the first batch."""
    rows = claims(spark, sf_dir, with_key=True)
    early = F.col("claim_year") <= LAST_YEAR_OF_FIRST_BATCH
    return (
        rows.filter(~early | (F.col("_k") % 10 == 0))
        .withColumn("claim_amount", F.when(early, F.col("claim_amount") * 1.1).otherwise(F.col("claim_amount")))
        .drop("_k")
        .withColumn("_batch_id", _batch("2"))
    )


def ledger_of_first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch ledger of a table that holds the first batch, counted from its rows."""
    return first_batch(spark, sf_dir).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


def half_year_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All claims, landed half-year by half-year under the numbers 1 to 14."""
    number = (F.col("claim_year") - 1992) * 2 + F.when(F.col("claim_month") > 6, 2).otherwise(1)
    return claims(spark, sf_dir).withColumn("_batch_id", number.cast("string"))


def with_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All claims, and for every fifth a twin that differs in its specialty alone."""
    rows = claims(spark, sf_dir, with_key=True)
    twins = rows.filter(F.col("_k") % 5 == 0).withColumn("provider_specialty", F.lit("twin"))
    return rows.unionByName(twins).drop("_k")
