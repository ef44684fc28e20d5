"""Column expressions shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlake.codes import SERVICES
from claimlake.params import Params

PRE, POST = "pre", "post"

# Amounts are added as decimals, so the order of addition cannot change a sum; the
# double nearest to the exact sum is taken once, at the end.
AMOUNT = "decimal(28,8)"


def exact_sum(column: str | Column) -> Column:
    amount = F.col(column) if isinstance(column, str) else column
    return F.sum(amount.cast(AMOUNT)).cast("double")


def exact_mean(column: str) -> Column:
    return exact_sum(column) / F.nullif(F.count(column), F.lit(0))


def iso_date(column: str) -> Column:
    """Text of the form yyyy-MM-dd to date; NULL for anything else.

    The cast is much cheaper than a format-driven parse but takes looser
    text too, so only text of the exact shape reaches it.
    """
    return F.regexp_extract(F.col(column), r"^\d{4}-\d{2}-\d{2}$", 0).try_cast("date")


def per(amount: Column, count: Column) -> Column:
    """``amount / count`` where a zero or missing count acts as one."""
    return amount / F.greatest(count, F.lit(1))


def period(year: Column, params: Params) -> Column:
    return F.when(year >= params.cutover_year, POST).otherwise(PRE)


def cost_tier(amount: Column, params: Params) -> Column:
    return (
        F.when(amount < params.low_cost_below, "low")
        .when(amount < params.medium_cost_below, "medium")
        .otherwise("high")
    )


def service_flags(service_type: Column) -> dict[str, Column]:
    return {flag: service_type == value for flag, value in SERVICES.items()}


def visits(flag: str) -> Column:
    """How many rows of a group carry a boolean flag."""
    return F.sum(F.col(flag).cast("int"))


def month_index(year: Column, month: Column) -> Column:
    """One integer per calendar month."""
    return year * 12 + month


def risk_tier(score: Column, params: Params) -> Column:
    return (
        F.when(score >= params.high_from, "high")
        .when(score >= params.moderate_from, "moderate")
        .otherwise("low")
    )
