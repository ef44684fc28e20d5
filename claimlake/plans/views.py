"""Published reports over the Gold tables. No report exposes a member id.

A report is a declaration; its SQL runs either over DataFrames (``run``) or
over named tables as views (``create_views``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimlake.codes import UNMAPPED_LABEL

SCORES, TRENDS, MAPPED = "scores", "trends", "mapped"


@dataclass(frozen=True)
class Report:
    source: str
    text: str

    def sql(self, table: str) -> str:
        return self.text.replace("{table}", table)


REPORTS: dict[str, Report] = {
    "v_high_risk_summary": Report(
        SCORES,
        """
        SELECT risk_tier, count(*) AS n_members, round(avg(raf_score), 3) AS mean_raf,
               round(avg(actual_pmpm), 2) AS mean_pmpm, sum(ip_admit_count) AS total_ip_admits,
               sum(ed_visit_count) AS total_ed_visits
        FROM {table} GROUP BY risk_tier
        """,
    ),
    "v_high_risk_share": Report(
        SCORES,
        """
        SELECT risk_tier, count(*) AS n_members,
               round(count(*) * 100.0D / sum(count(*)) OVER (), 1) AS pct_of_population,
               round(avg(raf_score), 3) AS mean_raf, round(avg(actual_pmpm), 2) AS mean_pmpm_usd,
               round(avg(estimated_annual_cost), 0) AS mean_est_cost_usd,
               sum(ip_admit_count) AS total_ip_admits, sum(ed_visit_count) AS total_ed_visits
        FROM {table} GROUP BY risk_tier
        """,
    ),
    "v_cohort_trends": Report(
        TRENDS,
        """
        SELECT service_year, service_month, intervention_arm, n_members, round(pmpm_cost, 2) AS pmpm_cost,
               round(pmpm_rolling_3m, 2) AS pmpm_3m_avg, ip_rate_per_1000, ed_rate_per_1000, period
        FROM {table} ORDER BY service_year, service_month, intervention_arm
        """,
    ),
    "v_top_hcc_conditions": Report(
        MAPPED,
        """
        SELECT primary_hcc_desc AS condition, count(DISTINCT bene_id) AS n_members,
               round(avg(hcc_raf_total), 3) AS mean_hcc_raf,
               round(cast(sum(cast(claim_amount AS decimal(28,8))) AS double), 0) AS total_claims_usd
        FROM {table} WHERE _quality_pass AND primary_hcc_desc IS NOT NULL
        GROUP BY primary_hcc_desc ORDER BY n_members DESC, condition LIMIT 20
        """,
    ),
    "v_top_mapped_conditions": Report(
        MAPPED,
        f"""
        SELECT primary_hcc_desc AS condition, primary_hcc AS hcc_number, count(DISTINCT bene_id) AS n_members,
               count(claim_id) AS n_claims, round(avg(hcc_raf_total), 3) AS mean_hcc_raf,
               round(cast(sum(cast(claim_amount AS decimal(28,8))) AS double), 0) AS total_cost_usd
        FROM {{table}} WHERE _quality_pass AND primary_hcc_desc <> '{UNMAPPED_LABEL}'
        GROUP BY primary_hcc_desc, primary_hcc ORDER BY n_members DESC, condition, hcc_number LIMIT 20
        """,
    ),
    "raf_by_tier": Report(
        SCORES,
        """
        SELECT risk_tier, count(*) AS n_members, round(avg(raf_score), 3) AS mean_raf,
               round(avg(actual_pmpm), 2) AS mean_pmpm, sum(ip_admit_count) AS total_ip_admits
        FROM {table} GROUP BY risk_tier ORDER BY mean_raf DESC, risk_tier
        """,
    ),
    "did_check": Report(
        TRENDS,
        """
        SELECT period, intervention_arm, round(avg(pmpm_cost), 2) AS mean_pmpm,
               count(DISTINCT service_month) AS n_months
        FROM {table} GROUP BY period, intervention_arm ORDER BY period DESC, intervention_arm
        """,
    ),
}


def run(spark: SparkSession, name: str, frame: DataFrame) -> DataFrame:
    """The report over a DataFrame holding its source."""
    return spark.sql(REPORTS[name].sql("{source}"), source=frame)


def create_views(
    spark: SparkSession, tables: Mapping[str, str], prefix: str = "", temporary: bool = False
) -> list[str]:
    """Create each ``v_`` report as a view over the named tables.

    ``tables`` maps scores, trends and mapped to table names. A view that
    cannot be created, or that would show a member id, raises.
    """
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    created = []
    for name, report in REPORTS.items():
        if not name.startswith("v_"):
            continue
        if "bene_id" in spark.sql(report.sql(tables[report.source])).columns:
            raise ValueError(f"{name} would expose member ids")
        spark.sql(f"CREATE OR REPLACE {kind} {prefix}{name} AS {report.sql(tables[report.source])}")
        created.append(prefix + name)
    return created
