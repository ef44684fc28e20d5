"""Silver tables to Gold tables and the feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimlake.operators import features, rollups
from claimlake.params import Params


def member_raf_scores(profile: DataFrame, mapped: DataFrame, params: Params) -> DataFrame:
    return rollups.score_members(profile, rollups.member_rollup(mapped), params)


def utilization_summary(clean: DataFrame) -> DataFrame:
    return rollups.utilization(clean)


def monthly_trends(clean: DataFrame, params: Params) -> DataFrame:
    return rollups.monthly_trends(clean, params)


def risk_feature_store(scores: DataFrame, clean: DataFrame) -> DataFrame:
    return features.feature_store(scores, features.pre_utilization(clean))
