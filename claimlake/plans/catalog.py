"""Every registered query, over the claims views of a table folder."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.codes import CONDITIONS, FEATURES, INTERACTIONS
from claimlake.functions import clinical
from claimlake.functions import expressions as X
from claimlake.operators import (
    association,
    claims as C,
    drift,
    explain,
    features,
    mapping,
    members,
    merge,
    modeling,
    rollups,
    savings,
    scoring,
    validation,
)
from claimlake.params import Params
from claimlake.plans import gold, pipeline, silver, views
from claimlake.sources import fixtures, schemas
from claimlake.sources.shared import kept

Query = Callable[[SparkSession, str], DataFrame]
CLASSES = ("high", "low", "moderate")
SHARING_RATES, MINIMUM_RATES = (0.3, 0.5, 0.7), (0.01, 0.02, 0.04)


class Lake:
    """Layer frames over one table folder, each limited to needed columns."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = fixtures.FIXTURE_PARAMS):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    def raw_claims(self) -> DataFrame:
        return validation.tag_null_keys(fixtures.claims(self.spark, self.sf_dir), ("claim_id", "bene_id"))

    def raw_members(self) -> DataFrame:
        return fixtures.members(self.spark, self.sf_dir)

    def clean(self, *needed: str) -> DataFrame:
        return silver.clean_claims(self.raw_claims(), self.params, needed)

    def clean_whole(self) -> DataFrame:
        return silver.clean_claims(self.raw_claims(), self.params)

    def mapped(self, *needed: str) -> DataFrame:
        return silver.mapped_claims(self.clean("icd10_codes", "service_type", *needed))

    def profile(self) -> DataFrame:
        return silver.member_profile(self.raw_members(), self.params)

    def scores(self) -> DataFrame:
        return gold.member_raf_scores(self.profile(), self.mapped(), self.params)

    def utilization(self) -> DataFrame:
        return gold.utilization_summary(self.clean("service_type", "intervention_arm", "allowed_amount"))

    def trends(self) -> DataFrame:
        return gold.monthly_trends(self.clean("service_type", "intervention_arm"), self.params)

    def pre_utilization(self) -> DataFrame:
        return features.pre_utilization(self.clean("service_type"))

    def store(self) -> DataFrame:
        return features.feature_store_in_one_pass(self.profile(), self.mapped(), self.params)

    def snapshots(self) -> tuple[DataFrame, DataFrame]:
        frames = features.period_snapshots(self.profile(), self.mapped(), self.params)
        return frames[X.PRE], frames[X.POST]

    def batches(self) -> DataFrame:
        return fixtures.first_batch(self.spark, self.sf_dir).unionByName(
            fixtures.second_batch(self.spark, self.sf_dir)
        )

    def report(self, name: str) -> DataFrame:
        source = views.REPORTS[name].source
        frame = {views.SCORES: self.scores, views.TRENDS: self.trends, views.MAPPED: self.mapped}[source]()
        return views.run(self.spark, name, frame)


LINE = ("claim_id", "bene_id", "service_date")
_REGISTRY: dict[str, Callable[[Lake], DataFrame]] = {}


def query(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    _REGISTRY[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    def bind(fn: Callable[[Lake], DataFrame]) -> Query:
        return lambda spark, sf_dir: fn(Lake(spark, sf_dir))

    return {name: bind(fn) for name, fn in _REGISTRY.items()}


# --- Bronze -----------------------------------------------------------------


@query
def bronze_null_profile(lake: Lake) -> DataFrame:
    return validation.null_profile(lake.raw_claims(), schemas.CLAIMS.names)


@query
def bronze_key_nulls(lake: Lake) -> DataFrame:
    raw = lake.raw_claims()
    keys = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in ("claim_id", "bene_id", "claim_amount")}
    flagged = F.count_if(validation.BRONZE_NULL).alias("n_flagged")
    return raw.agg(*[n.alias(name) for name, n in keys.items()], flagged)


@query
def bronze_volume_by_month(lake: Lake) -> DataFrame:
    return C.volume_by_month(lake.raw_claims()).orderBy("claim_year", "claim_month")


@query
def bronze_service_mix(lake: Lake) -> DataFrame:
    return validation.value_counts(lake.raw_claims(), "service_type", "intervention_arm")


@query
def bronze_audit(lake: Lake) -> DataFrame:
    at = F.lit("2001-06-30 00:00:00").cast("timestamp_ntz")
    rows = validation.add_audit_columns(lake.raw_claims(), "bronze", "20010630000000", at)
    audit = list(pipeline.AUDIT)
    return rows.groupBy(validation.BRONZE_NULL, *audit).agg(F.count(F.lit(1)).alias("n"))


@query
def bronze_batch_guard(lake: Lake) -> DataFrame:
    """Both batches arrive; the ledger of the table lists the first."""
    ledger = fixtures.ledger_of_first_batch(lake.spark, lake.sf_dir)
    accepted = merge.only_new_batches(lake.batches(), ledger)
    return accepted.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("bene_id").alias("n_members")
    )


@query
def bronze_read_as_of(lake: Lake) -> DataFrame:
    """Row counts of a table of 14 batches at two versions, and of newest rows per key."""
    table = fixtures.half_year_batches(lake.spark, lake.sf_dir)
    table = table.select(*LINE, "paid_amount", "claim_amount", "_batch_id")
    parts = {
        "version 2": merge.read_as_of(table, "2"),
        "version 10": merge.read_as_of(table, "10"),
        "newest per key": merge.latest_per_key(table, LINE),
    }
    rows = [
        df.groupBy("_batch_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(X.exact_sum("claim_amount"), 2).alias("total_amount"))
        .withColumn("view", F.lit(name))
        for name, df in parts.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def bronze_upsert(lake: Lake) -> DataFrame:
    columns = (*LINE, "claim_amount", "paid_amount", "_batch_id")
    target = fixtures.first_batch(lake.spark, lake.sf_dir).select(*columns)
    updates = C.dedup_keep_best(fixtures.second_batch(lake.spark, lake.sf_dir).select(*columns), LINE)
    return merge.merge_upsert(target, updates, LINE)


@query
def bronze_schema_evolve(lake: Lake) -> DataFrame:
    old = fixtures.first_batch(lake.spark, lake.sf_dir).drop("plan_type")
    new = fixtures.second_batch(lake.spark, lake.sf_dir)
    return merge.evolve_union(old, new).groupBy("_batch_id", "plan_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def bronze_schema_issues(lake: Lake) -> DataFrame:
    """Raw claims, without their plan, against the types Silver gives them."""
    from pyspark.sql import types as T

    wanted = T.StructType(
        [T.StructField("service_date", T.DateType()), *[f for f in schemas.CLAIMS if f.name != "service_date"]]
    )
    return validation.schema_issues(lake.raw_claims().drop("plan_type"), wanted)


# --- Silver -----------------------------------------------------------------


@query
def silver_typed(lake: Lake) -> DataFrame:
    return C.cast_claims(lake.raw_claims()).drop(validation.BRONZE_NULL)


@query
def silver_month_fill(lake: Lake) -> DataFrame:
    raw = lake.raw_claims().withColumn(
        "claim_month", F.when(F.col("claim_month") != 6, F.col("claim_month"))
    )
    typed = C.cast_claims(raw, keep_given_month=True)
    return typed.groupBy("claim_year", "claim_month").agg(F.count(F.lit(1)).alias("n"))


@query
def silver_dedup(lake: Lake) -> DataFrame:
    return C.dedup_keep_best(C.cast_claims(lake.raw_claims()), lake.params.dedup_keys).drop(validation.BRONZE_NULL)


@query
def silver_refreshed(lake: Lake) -> DataFrame:
    """Cleaned claims of the first batch, brought up to date with the second."""
    first = fixtures.first_batch(lake.spark, lake.sf_dir).drop("_batch_id")
    second = fixtures.second_batch(lake.spark, lake.sf_dir).drop("_batch_id")
    clean = silver.clean_claims(first, lake.params, keep_tie=True)
    months = silver.service_months(second)
    same = [clean[c].eqNullSafe(months[c]) for c in months.columns]
    # the calendar bounds the months, so no claim is shuffled to meet them
    fresh = silver.refreshed_claims(clean.join(F.broadcast(months), same, "left_semi"), second, lake.params)
    whole = clean.drop("_tie").join(F.broadcast(months), same, "left_anti").unionByName(fresh)
    return whole.select(*LINE, "claim_amount", "paid_amount", "provider_specialty", "service_year", "cost_tier", validation.QUALITY_PASS)


@query
def silver_dedup_ties(lake: Lake) -> DataFrame:
    """Which of two lines of one key and equal amounts stays, for two column lists."""
    raw = fixtures.with_twins(lake.spark, lake.sf_dir)
    tagged = validation.tag_null_keys(raw, ("claim_id", "bene_id"))
    narrow = silver.clean_claims(tagged, lake.params, ("provider_specialty",))
    wide = silver.clean_claims(tagged, lake.params)
    counts = [
        df.groupBy("provider_specialty").agg(F.count(F.lit(1)).alias("n")).withColumn("columns", F.lit(name))
        for name, df in (("narrow", narrow), ("wide", wide))
    ]
    return counts[0].unionByName(counts[1])


@query
def silver_flagged(lake: Lake) -> DataFrame:
    return lake.clean().select(*LINE, "claim_amount", *C.flags(), validation.QUALITY_PASS)


@query
def silver_quality_summary(lake: Lake) -> DataFrame:
    return validation.quality_summary(lake.clean())


@query
def silver_flag_breakdown(lake: Lake) -> DataFrame:
    return validation.flag_breakdown(lake.clean(), C.flags())


@query
def silver_features(lake: Lake) -> DataFrame:
    derived = (
        "service_year", "service_month", "service_quarter", "day_of_week", "is_weekend", "period",
        "is_inpatient", "is_ed_visit", "is_specialist", "is_primary_care", "cost_tier",
    )
    return lake.clean("service_type").select(*LINE, "claim_amount", *derived)


@query
def member_profile(lake: Lake) -> DataFrame:
    return lake.profile()


@query
def member_profile_by_sex(lake: Lake) -> DataFrame:
    return members.profile_by_sex(lake.profile())


# --- Mapping ----------------------------------------------------------------


@query
def hcc_reference(lake: Lake) -> DataFrame:
    return mapping.crosswalk_usage(lake.clean("icd10_primary"), clinical.crosswalk_frame(lake.spark))


def _joined_list(df: DataFrame) -> DataFrame:
    return df.withColumn("hcc_list", F.concat_ws(",", F.col("hcc_list").cast("array<string>")))


@query
def hcc_mapped(lake: Lake) -> DataFrame:
    mapped = lake.mapped().select(
        *LINE, "hcc_list", "hcc_raf_total", "primary_hcc", "primary_hcc_desc", "hcc_burden_count",
        "hcc_interaction_total",
    )
    return _joined_list(mapped)


@query
def hcc_mapped_join_form(lake: Lake) -> DataFrame:
    lines = rollups.passing(lake.clean("icd10_codes"))
    mapped = mapping.map_by_join(lines, clinical.crosswalk_frame(lake.spark), list(LINE)).select(
        *LINE, "hcc_list", "hcc_raf_total", "primary_hcc", "primary_hcc_desc", "hcc_burden_count",
        "hcc_interaction_total",
    )
    return _joined_list(mapped)


@query
def hcc_primary(lake: Lake) -> DataFrame:
    return lake.mapped().groupBy("icd10_primary", "primary_hcc", "primary_hcc_desc").agg(
        F.count(F.lit(1)).alias("n_claims")
    )


@query
def hcc_condition_flags(lake: Lake) -> DataFrame:
    return lake.mapped().select(*LINE, *CONDITIONS)


@query
def hcc_interactions(lake: Lake) -> DataFrame:
    return lake.mapped().select(*LINE, *INTERACTIONS, "hcc_interaction_total")


@query
def hcc_sql_functions(lake: Lake) -> DataFrame:
    clinical.register_sql_functions(lake.spark)
    return lake.spark.sql(
        """
        SELECT claim_id, bene_id, service_date,
               concat_ws(',', cast(icd_to_hcc_list(icd10_codes) AS array<string>)) AS hcc_list,
               icd_to_hcc_raf_total(icd10_codes) AS hcc_raf_total,
               icd_to_primary_hcc(icd10_primary) AS primary_hcc,
               icd_to_primary_hcc_desc(icd10_primary) AS primary_hcc_desc
        FROM {lines} WHERE _quality_pass
        """,
        lines=lake.clean("icd10_codes"),
    )


@query
def hcc_prevalence(lake: Lake) -> DataFrame:
    return mapping.prevalence(lake.mapped())


@query
def hcc_top_conditions(lake: Lake) -> DataFrame:
    return mapping.top_conditions(lake.mapped())


# --- Gold -------------------------------------------------------------------


@query
def gold_member_rollup(lake: Lake) -> DataFrame:
    return rollups.member_rollup(lake.mapped())


@query
def gold_raf_scores(lake: Lake) -> DataFrame:
    return lake.scores()


@query
def gold_raf_member_union(lake: Lake) -> DataFrame:
    union = rollups.member_union_scores(lake.profile(), lake.mapped())
    return _joined_list(
        union.select("bene_id", "hcc_list", "union_hcc_raf", "union_interaction_raf", "raf_score_member_union")
    )


@query
def gold_tier_summary(lake: Lake) -> DataFrame:
    return rollups.tier_summary(lake.scores()).orderBy(F.desc("mean_raf"), "risk_tier")


@query
def gold_run_summary(lake: Lake) -> DataFrame:
    return rollups.tier_counts(lake.scores())


@query
def gold_table_rows(lake: Lake) -> DataFrame:
    """Rows of the Silver and Gold tables, from one pass over the clean claims."""
    counted = pipeline.table_rows(lake.clean("intervention_arm"))
    return counted.unionByName(pipeline.run_summary(member_profile=lake.profile()))


@query
def gold_utilization(lake: Lake) -> DataFrame:
    return lake.utilization()


@query
def gold_utilization_by_arm(lake: Lake) -> DataFrame:
    return rollups.utilization_by_arm(lake.utilization()).orderBy(F.desc("period"), "intervention_arm")


@query
def gold_monthly_trends(lake: Lake) -> DataFrame:
    rows = lake.trends().withColumn("pmpm_rolling_3m", F.round("pmpm_rolling_3m", 6))
    return rows.orderBy("service_year", "service_month", "intervention_arm")


@query
def gold_did_estimate(lake: Lake) -> DataFrame:
    effect = rollups.did_estimate(lake.trends())
    return effect.select(*[F.round(c, 6).alias(c) for c in effect.columns])


@query
def gold_pre_trend_slopes(lake: Lake) -> DataFrame:
    return rollups.pre_trend_slopes(lake.trends())


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    doubles = [f for f, kind in df.dtypes if kind == "double"]
    return df.withColumns({f: F.round(f, digits) for f in doubles})


@query
def gold_parallel_trends(lake: Lake) -> DataFrame:
    return _rounded(association.parallel_trends(lake.trends()), 5)


@query
def gold_event_study(lake: Lake) -> DataFrame:
    return _rounded(association.event_study(lake.trends()), 6)


@query
def hcc_co_occurrence(lake: Lake) -> DataFrame:
    return _rounded(association.co_occurrence(lake.mapped()), 6)


@query
def ml_correlations(lake: Lake) -> DataFrame:
    return _rounded(association.correlations(modeling.feature_matrix(lake.store()), FEATURES), 6)


@query
def gold_pre_utilization(lake: Lake) -> DataFrame:
    return lake.pre_utilization()


_LOGS = ("log_pre_pmpm", "log_estimated_cost", "log_pre_total_cost")


@query
def gold_feature_store(lake: Lake) -> DataFrame:
    return lake.store().withColumns({c: F.round(c, 6) for c in _LOGS})


@query
def gold_feature_store_joined(lake: Lake) -> DataFrame:
    store = features.feature_store(lake.scores(), lake.pre_utilization())
    return store.withColumns({c: F.round(c, 6) for c in _LOGS})


@query
def gold_feature_store_by_tier(lake: Lake) -> DataFrame:
    return features.features_by_tier(lake.store()).orderBy(F.desc("mean_raf"), "risk_tier")


# --- Published reports ------------------------------------------------------


@query
def view_high_risk(lake: Lake) -> DataFrame:
    return lake.report("v_high_risk_summary")


@query
def view_high_risk_pct(lake: Lake) -> DataFrame:
    return lake.report("v_high_risk_share")


@query
def view_cohort_trends(lake: Lake) -> DataFrame:
    return lake.report("v_cohort_trends")


@query
def view_top_hcc(lake: Lake) -> DataFrame:
    return lake.report("v_top_hcc_conditions")


@query
def view_top_hcc_mapped(lake: Lake) -> DataFrame:
    return lake.report("v_top_mapped_conditions")


@query
def sql_raf_by_tier(lake: Lake) -> DataFrame:
    return lake.report("raf_by_tier")


@query
def sql_did_check(lake: Lake) -> DataFrame:
    return lake.report("did_check")


# --- Savings ----------------------------------------------------------------


_MONEY = (
    "att_annual_savings", "actual_pmpm", "gross_savings", "savings_rate", "earned_savings",
    "per_member_gross", "per_member_earned",
)


def _rounded_money(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in _MONEY if c in df.columns})


def _effect(lake: Lake) -> DataFrame:
    """The estimated effect as an annual saving (positive = cost went down)."""
    saved = F.round(-F.col("att_annual"), 6)
    return rollups.did_estimate(lake.trends()).select(saved.alias("att_annual_savings"))


@query
def savings_actual(lake: Lake) -> DataFrame:
    return _rounded_money(savings.savings_from_scores(lake.scores(), lake.params))


@query
def savings_by_state(lake: Lake) -> DataFrame:
    return _rounded_money(savings.savings_from_scores(lake.scores(), lake.params, by=["state"]))


@query
def savings_from_att(lake: Lake) -> DataFrame:
    rows = _effect(lake).withColumn("n_lives", F.lit(10_000))
    return _rounded_money(savings.savings_from_att(rows, lake.params))


@query
def savings_projection(lake: Lake) -> DataFrame:
    return _rounded_money(savings.project(_effect(lake), lake.params))


@query
def savings_grid(lake: Lake) -> DataFrame:
    cohort = savings.cohort_actuals(lake.scores(), lake.params)
    return _rounded_money(savings.override_grid(cohort, SHARING_RATES, MINIMUM_RATES, lake.params))


# --- Drift ------------------------------------------------------------------


def _drift_counts(lake: Lake) -> DataFrame:
    baseline, current = lake.snapshots()
    return drift.value_counts(baseline, current, drift.shared_features(baseline, current))


def _six_decimals(column: str) -> Column:
    """Rounded by the same two operations as in the SQL; the engines' own rounding differs at ties."""
    return F.floor(F.col(column) * 1e6 + 0.5) / 1e6


@query
def drift_bins(lake: Lake) -> DataFrame:
    edges = drift.baseline_edges(_drift_counts(lake), lake.params)
    return edges.select("feature", F.posexplode("edges").alias("position", "edge")).withColumn(
        "edge", _six_decimals("edge")
    )


@query
def drift_histogram(lake: Lake) -> DataFrame:
    counts = _drift_counts(lake)
    bins = drift.histogram(counts, drift.baseline_edges(counts, lake.params), lake.params)
    return bins.withColumns({c: _six_decimals(c) for c in ("lower_edge", "upper_edge")})


@query
def drift_report(lake: Lake) -> DataFrame:
    return drift.monitor_drift(*lake.snapshots(), lake.params)


@query
def drift_overall(lake: Lake) -> DataFrame:
    return drift.report_overall(drift_report(lake))


# --- Model ------------------------------------------------------------------


@query
def ml_matrix(lake: Lake) -> DataFrame:
    return modeling.feature_matrix(lake.store()).withColumns({c: F.round(c, 6) for c in _LOGS})


@query
def ml_split(lake: Lake) -> DataFrame:
    labels = lake.scores().select("bene_id", "risk_tier")
    return modeling.stratified_split(labels, lake.params)


@query
def ml_labels(lake: Lake) -> DataFrame:
    return modeling.label_index(lake.scores())


def _demo_predictions(lake: Lake) -> DataFrame:
    """A stand-in model: tier and cost from the score plus noise keyed on the member.

    Plain arithmetic, so that the metrics over it can be checked exactly.
    """
    key = F.substring("bene_id", 4, 20).cast("bigint")
    noise = ((key * 37) % 100 - 50).cast("double") / 100.0
    s = F.col("raf_score") + F.col("noise")
    centers = {"high": 2.6, "low": 0.8, "moderate": 1.6}
    weights = {c: 1 / (0.05 + F.abs(s - center)) for c, center in centers.items()}
    rows = (
        lake.scores()
        .select("bene_id", "risk_tier", "raf_score", "estimated_annual_cost", noise.alias("noise"))
        .withColumns(
            {
                "predicted_cost": F.col("estimated_annual_cost") * (1 + F.col("noise") / 5),
                "predicted_tier": X.risk_tier(s, lake.params),
                **{f"_{c}": w for c, w in weights.items()},
            }
        )
    )
    total = F.col("_high") + F.col("_low") + F.col("_moderate")
    shares = {f"prob_{c}": F.col(f"_{c}") / total for c in CLASSES}
    own = F.coalesce(*[F.when(F.col("predicted_tier") == c, F.col(f"_{c}")) for c in CLASSES])
    return rows.withColumns({**shares, "confidence": own / total}).drop("noise", "raf_score", *[f"_{c}" for c in CLASSES])


@query
def ml_accuracy(lake: Lake) -> DataFrame:
    return scoring.accuracy(_demo_predictions(lake))


@query
def ml_class_report(lake: Lake) -> DataFrame:
    return scoring.class_report(_demo_predictions(lake))


@query
def ml_auc_ovr(lake: Lake) -> DataFrame:
    return scoring.auc_one_vs_rest(_demo_predictions(lake), CLASSES)


@query
def ml_auc_macro(lake: Lake) -> DataFrame:
    return scoring.macro_auc(_demo_predictions(lake), CLASSES)


@query
def ml_regression_metrics(lake: Lake) -> DataFrame:
    return scoring.regression_metrics(_demo_predictions(lake))


@query
def ml_confusion(lake: Lake) -> DataFrame:
    return scoring.confusion(_demo_predictions(lake))


@query
def ml_ece(lake: Lake) -> DataFrame:
    return scoring.expected_calibration_error(_demo_predictions(lake))


def _split_store(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Training and test members; the store is read by the split, the fits and the predictions, so it is kept."""
    split = modeling.stratified_split(kept(lake.store(), "store"), lake.params)
    return split.filter("is_train"), split.filter(~F.col("is_train"))


def _checked(predicted: DataFrame) -> DataFrame:
    """Per member its tier, and what must hold of any prediction."""
    shares = [F.col(f"prob_{c}") for c in CLASSES]
    total = shares[0] + shares[1] + shares[2]
    claimed = F.coalesce(*[F.when(F.col("predicted_tier") == c, F.col(f"prob_{c}")) for c in CLASSES])
    cost = F.col("predicted_cost")
    return predicted.select(
        "bene_id",
        "risk_tier",
        (F.abs(total - 1) < 1e-9).alias("shares_sum_to_one"),
        (claimed == F.greatest(*shares)).alias("tier_is_likeliest"),
        (~F.isnan(cost) & (F.abs(cost) < float("inf"))).alias("cost_is_finite"),
    )


@query
def ml_predictions(lake: Lake) -> DataFrame:
    """The forest's predictions for the test members, reduced to what SQL can state."""
    train, test = _split_store(lake)
    return _checked(modeling.RiskModel(lake.params).fit(train, calibrate=False).predict(test))


@query
def ml_member_predictions(lake: Lake) -> DataFrame:
    """Predicted tier, probabilities and cost of every test member, calibrated on the training members."""
    train, test = _split_store(lake)
    return modeling.RiskModel(lake.params).fit(train).predict(test)


@query
def ml_boosted(lake: Lake) -> DataFrame:
    train, test = _split_store(lake)
    return _checked(modeling.RiskModel(lake.params, learner="boosted").fit(train, calibrate=False).predict(test))


@query
def ml_evaluation(lake: Lake) -> DataFrame:
    """Whether the calibrated model's metrics on the test members are what they must be."""
    train, test = _split_store(lake)
    predicted = kept(modeling.RiskModel(lake.params).fit(train).predict(test), "predicted")
    tiers = test.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    majority = tiers.agg((F.max("n") / F.sum("n")).alias("majority"))
    metrics = [
        scoring.accuracy(predicted),
        majority,
        scoring.macro_auc(predicted, CLASSES),
        scoring.regression_metrics(predicted),
        scoring.expected_calibration_error(predicted).select("ece"),
    ]
    one_row = metrics[0].select(F.struct("*").alias("m0"))
    for i, metric in enumerate(metrics[1:], 1):
        one_row = one_row.withColumn(f"m{i}", metric.select(F.struct("*")).scalar())
    return one_row.select(
        F.col("m0.n").alias("n"),
        (F.col("m0.tier_accuracy") > F.col("m1.majority")).alias("beats_majority"),
        F.col("m2.auc_macro").between(0.5, 1.0).alias("auc_above_chance"),
        ((F.col("m3.cost_mae") >= 0) & (F.col("m3.cost_rmse") >= F.col("m3.cost_mae"))).alias("errors_in_order"),
        (F.col("m3.cost_r2") <= 1.0).alias("r2_in_range"),
        F.col("m4.ece").between(0.0, 1.0).alias("ece_in_range"),
    )


@query
def ml_calibrated(lake: Lake) -> DataFrame:
    """Monotone fit of being high-risk over the stand-in's score, on two decimals."""
    params = dataclasses.replace(lake.params, calibration_digits=2)
    grid = modeling.calibration_grid(_demo_predictions(lake), "prob_high", F.col("risk_tier") == "high", params)
    fitted = modeling.fit_calibrator(grid, "calibrated").transform(grid)
    return fitted.select("point", F.col("w").alias("n"), F.round("calibrated", 6).alias("calibrated"))


def _arithmetic_model(matrix: DataFrame, params: Params) -> DataFrame:
    """A stand-in model over the matrix: a tier from plain arithmetic on a few features."""
    score = F.col("demographic_raf") + F.col("max_hcc_raf") + F.col("max_interaction_raf") + F.col("pre_ed_visits") * 0.02
    return matrix.withColumn("predicted_tier", X.risk_tier(score, params))


@query
def ml_permutation_importance(lake: Lake) -> DataFrame:
    """What the stand-in model loses when each of the features is exchanged between members."""
    ranked = explain.permutation_importance(
        modeling.feature_matrix(lake.store()), FEATURES, lambda df: _arithmetic_model(df, lake.params),
        F.col("predicted_tier") == F.col("risk_tier"), "bene_id",
    )
    return _rounded(ranked, 6)


@query
def ml_attribution(lake: Lake) -> DataFrame:
    """Per test member, whether the features' parts add up to each of the model's scores."""
    train, test = _split_store(lake)
    model = modeling.RiskModel(lake.params).fit(train, calibrate=False)
    sums = model.attribution(test).groupBy("bene_id").agg(
        F.count_distinct("output").alias("n_outputs"),
        *[F.sum(F.when(F.col("output") == o, F.col("contribution"))).alias(f"_{o}") for o in (*CLASSES, modeling.COST)],
    )
    close = F.abs(F.col("predicted_cost") - F.col(f"_{modeling.COST}")) < 1e-6 * (1 + F.abs("predicted_cost"))
    for c in CLASSES:
        close = close & (F.abs(F.col(f"prob_{c}") - F.col(f"_{c}")) < 1e-9)
    return model.predict(test).join(sums, "bene_id").select("bene_id", "risk_tier", "n_outputs", close.alias("adds_up"))


@query
def ml_importance(lake: Lake) -> DataFrame:
    """All features, and whether their importances are ranked and add up to one."""
    train, _ = _split_store(lake)
    model = modeling.RiskModel(lake.params, features=FEATURES).fit(train, calibrate=False)
    ranked = model.importance(len(FEATURES))
    in_order = Window.partitionBy().orderBy("rank")
    everything = Window.partitionBy()
    return ranked.select(
        "feature",
        F.coalesce(F.col("importance") <= F.lag("importance").over(in_order), F.col("rank") == 1).alias("ranked"),
        (F.abs(F.sum("importance").over(everything) - 1) < 1e-9).alias("sums_to_one"),
        (F.max("rank").over(everything) == F.count(F.lit(1)).over(everything)).alias("ranks_complete"),
    )
