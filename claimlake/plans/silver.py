"""Bronze claims and members to Silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.operators import claims as C
from claimlake.operators import mapping, members
from claimlake.operators import rollups
from claimlake.operators.validation import BRONZE_NULL, flag_quality_issues, tag_null_keys
from claimlake.params import Params

# Columns that deduplication and the quality rules read.
CHECKED = ("claim_id", "bene_id", "service_date", "icd10_primary", *C.AMOUNTS)

# What decides between lines of one key, whatever the caller goes on to use.
BEST_FIRST = ("claim_amount", "allowed_amount", "_tie")


def clean_claims(
    raw: DataFrame, params: Params, needed: Sequence[str] | None = None, keep_tie: bool = False
) -> DataFrame:
    """Typed, deduplicated, flagged claims with derived features.

    ``needed`` names the raw columns the caller goes on to use, beside those
    the checks read; other columns are dropped before the shuffle. ``keep_tie`` leaves
    the digest that decided between lines, for a refresh that follows at once.
    """
    raw = raw.withColumn("_tie", C.tie_digest(raw))
    if needed is not None:
        keep = dict.fromkeys([*CHECKED, *needed, *[c for c in raw.columns if c in (BRONZE_NULL, "_tie")]])
        raw = raw.select(*keep)
    if BRONZE_NULL not in raw.columns:
        raw = tag_null_keys(raw, ("claim_id", "bene_id"))
    typed = C.cast_claims(raw)
    best = C.dedup_keep_best(typed, params.dedup_keys, "paid_amount", BEST_FIRST)
    return judged(best if keep_tie else best.drop("_tie"), params)


def judged(best: DataFrame, params: Params) -> DataFrame:
    """Deduplicated lines with their flags and derived features."""
    return C.derive_features(flag_quality_issues(best, C.quality_rules(params)), params)


def refreshed_claims(clean: DataFrame, arrived: DataFrame, params: Params) -> DataFrame:
    """``clean``, brought up to date with raw lines that came since.

    ``clean`` needs to hold the partitions of the new lines' service months only: the
    service date is part of the key, so lines of other months cannot be touched. Equals
    cleaning all raw lines at once, but for raw columns that ``clean`` lacks, which stay out.
    Where ``clean`` kept its ``_tie``, its text columns are not read for another.
    """
    if "service_date" not in params.dedup_keys:
        raise ValueError("lines of a key may lie in any month; clean all of them")
    if BRONZE_NULL not in arrived.columns:
        arrived = tag_null_keys(arrived, ("claim_id", "bene_id"))
    typed = C.cast_claims(arrived.withColumn("_tie", C.tie_digest(arrived)))
    tie = F.col("_tie") if "_tie" in clean.columns else C.tie_digest(clean)
    former = clean.select(*[c for c in typed.columns if c in clean.columns and c != "_tie"], tie.alias("_tie"))
    best = C.keep_best_with(former, typed, params.dedup_keys, "paid_amount", BEST_FIRST).drop("_tie")
    return judged(best, params)


def service_months(arrived: DataFrame) -> DataFrame:
    """The partitions that raw lines belong to, NULL where the date cannot be read."""
    dates = C.cast_claims(arrived.select("service_date"))
    return dates.select(F.col("claim_year").alias("service_year"), F.col("claim_month").alias("service_month")).distinct()


def mapped_claims(clean: DataFrame) -> DataFrame:
    """Quality-pass claims with their condition categories."""
    return mapping.map_claims(rollups.passing(clean))


def member_profile(raw_members: DataFrame, params: Params) -> DataFrame:
    return members.member_profile(raw_members, params)
