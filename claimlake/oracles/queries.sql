-- bronze_null_profile: raw_claims
UNPIVOT (
    SELECT count(*) FILTER (claim_id IS NULL) AS claim_id, count(*) FILTER (bene_id IS NULL) AS bene_id,
           count(*) FILTER (service_date IS NULL) AS service_date, count(*) FILTER (claim_year IS NULL) AS claim_year,
           count(*) FILTER (claim_month IS NULL) AS claim_month, count(*) FILTER (service_type IS NULL) AS service_type,
           count(*) FILTER (icd10_primary IS NULL) AS icd10_primary, count(*) FILTER (icd10_codes IS NULL) AS icd10_codes,
           count(*) FILTER (provider_specialty IS NULL) AS provider_specialty,
           count(*) FILTER (claim_amount IS NULL) AS claim_amount, count(*) FILTER (allowed_amount IS NULL) AS allowed_amount,
           count(*) FILTER (paid_amount IS NULL) AS paid_amount, count(*) FILTER (plan_type IS NULL) AS plan_type,
           count(*) FILTER (intervention_arm IS NULL) AS intervention_arm
    FROM raw_claims
) ON COLUMNS(*) INTO NAME column_name VALUE n_null

-- bronze_key_nulls: raw_claims
SELECT count(*) FILTER (claim_id IS NULL) AS null_claim_id, count(*) FILTER (bene_id IS NULL) AS null_bene_id,
       count(*) FILTER (claim_amount IS NULL) AS null_claim_amount, count(*) FILTER (_bronze_null_flag) AS n_flagged
FROM raw_claims

-- bronze_volume_by_month: raw_claims
SELECT claim_year, claim_month, count(*) AS n_claims, count(DISTINCT bene_id) AS n_members,
       round(exact_sum(claim_amount), 0) AS total_cost_usd,
       round(exact_sum(claim_amount) / count(claim_amount), 2) AS avg_claim_usd
FROM raw_claims GROUP BY claim_year, claim_month ORDER BY claim_year, claim_month

-- bronze_service_mix: raw_claims
SELECT service_type, intervention_arm, count(*) AS n FROM raw_claims GROUP BY ALL

-- bronze_audit: raw_claims
SELECT _bronze_null_flag, TIMESTAMP '2001-06-30 00:00:00' AS _ingested_at, 'bronze' AS _pipeline_layer,
       '20010630000000' AS _batch_id, count(*) AS n
FROM raw_claims GROUP BY _bronze_null_flag

-- bronze_batch_guard: batch_two
SELECT _batch_id, count(*) AS n_rows, count(DISTINCT bene_id) AS n_members FROM batch_two GROUP BY _batch_id

-- bronze_read_as_of: half_years
SELECT view, _batch_id, count(*) AS n_rows, round(exact_sum(claim_amount), 2) AS total_amount FROM (
    SELECT 'version 2' AS view, _batch_id, claim_amount FROM half_years WHERE number <= 2
    UNION ALL SELECT 'version 10', _batch_id, claim_amount FROM half_years WHERE number <= 10
    UNION ALL SELECT 'newest per key', _batch_id, claim_amount FROM (
        SELECT _batch_id, claim_amount, row_number() OVER (
            PARTITION BY claim_id, bene_id, service_date
            ORDER BY number DESC NULLS LAST, claim_amount DESC NULLS LAST, paid_amount DESC NULLS LAST) AS _rank
        FROM half_years
    ) WHERE _rank = 1
) GROUP BY view, _batch_id

-- bronze_upsert: batch_one batch_two
SELECT claim_id, bene_id, service_date, claim_amount, paid_amount, _batch_id FROM batch_one b
WHERE NOT EXISTS (
    SELECT 1 FROM batch_two u
    WHERE u.claim_id = b.claim_id AND u.bene_id = b.bene_id AND u.service_date = b.service_date)
UNION ALL
SELECT claim_id, bene_id, service_date, claim_amount, paid_amount, _batch_id FROM (
    SELECT *, row_number() OVER (
        PARTITION BY claim_id, bene_id, service_date
        ORDER BY paid_amount DESC NULLS LAST, claim_amount DESC NULLS LAST) AS _rank
    FROM batch_two
) WHERE _rank = 1

-- bronze_schema_evolve: batch_one batch_two
SELECT _batch_id, plan_type, count(*) AS n_rows FROM (
    SELECT _batch_id, NULL AS plan_type FROM batch_one UNION ALL SELECT _batch_id, plan_type FROM batch_two
) GROUP BY _batch_id, plan_type

-- bronze_schema_issues: raw_claims
SELECT 'service_date' AS column_name, 'TYPE MISMATCH' AS issue,
       count(*) FILTER (service_date IS NOT NULL AND TRY_CAST(service_date AS DATE) IS NULL) AS n_rows
FROM raw_claims
UNION ALL
SELECT 'plan_type', 'MISSING', count(*) FROM raw_claims

-- silver_typed: typed
SELECT * EXCLUDE (_bronze_null_flag) FROM typed

-- silver_month_fill: raw_claims
SELECT coalesce(claim_year, year(TRY_CAST(service_date AS DATE)))::INTEGER AS claim_year,
       coalesce(CASE WHEN claim_month <> 6 THEN claim_month END, month(TRY_CAST(service_date AS DATE)))::INTEGER AS claim_month,
       count(*) AS n
FROM raw_claims GROUP BY ALL

-- silver_dedup: deduped
SELECT * EXCLUDE (_bronze_null_flag) FROM deduped

-- silver_refreshed: batch_one batch_two
SELECT claim_id, bene_id, service_date, claim_amount, paid_amount, provider_specialty,
       year(service_date)::INTEGER AS service_year,
       CASE WHEN claim_amount < 500 THEN 'low' WHEN claim_amount < 5000 THEN 'medium' ELSE 'high' END AS cost_tier,
       NOT (claim_id IS NULL OR bene_id IS NULL OR claim_amount < 0 OR claim_amount = 0
            OR claim_amount > 500000 OR service_date > DATE '2001-06-30' OR service_date IS NULL
            OR icd10_primary IS NULL) AS _quality_pass
FROM (
    SELECT *, row_number() OVER (
        PARTITION BY claim_id, bene_id, service_date
        ORDER BY paid_amount DESC NULLS LAST, claim_amount DESC NULLS LAST, allowed_amount DESC NULLS LAST, {tie} DESC
    ) AS _rank
    FROM (
        SELECT * REPLACE (TRY_CAST(service_date AS DATE) AS service_date)
        FROM (SELECT * FROM batch_one UNION ALL SELECT * FROM batch_two)
    )
) WHERE _rank = 1

-- silver_dedup_ties: keyed_claims
SELECT provider_specialty, n, columns FROM (
    SELECT provider_specialty, count(*) AS n FROM (
        SELECT *, row_number() OVER (
            PARTITION BY claim_id, bene_id, TRY_CAST(service_date AS DATE)
            ORDER BY paid_amount DESC NULLS LAST, claim_amount DESC NULLS LAST, allowed_amount DESC NULLS LAST,
                     {tie} DESC) AS _rank
        FROM (
            FROM keyed_claims
            UNION ALL SELECT * REPLACE ('twin' AS provider_specialty) FROM keyed_claims WHERE _k % 5 = 0
        )
    ) WHERE _rank = 1 GROUP BY provider_specialty
), (VALUES ('narrow'), ('wide')) v(columns)

-- silver_flagged: flagged
SELECT claim_id, bene_id, service_date, claim_amount, COLUMNS('^flag_.*'), _quality_pass FROM flagged

-- silver_quality_summary: flagged
SELECT count(*) AS n_total, count(*) FILTER (_quality_pass) AS n_pass, count(*) FILTER (NOT _quality_pass) AS n_fail,
       count(*) FILTER (_quality_pass IS NULL) AS n_unknown
FROM flagged

-- silver_flag_breakdown: flagged
SELECT sum(flag_null_claim_id::INTEGER)::BIGINT AS flag_null_claim_id, sum(flag_null_bene_id::INTEGER)::BIGINT AS flag_null_bene_id,
       sum(flag_negative_amount::INTEGER)::BIGINT AS flag_negative_amount, sum(flag_zero_amount::INTEGER)::BIGINT AS flag_zero_amount,
       sum(flag_excessive_amount::INTEGER)::BIGINT AS flag_excessive_amount, sum(flag_future_date::INTEGER)::BIGINT AS flag_future_date,
       sum(flag_null_service_date::INTEGER)::BIGINT AS flag_null_service_date, sum(flag_null_icd10::INTEGER)::BIGINT AS flag_null_icd10,
       sum(flag_bronze_null::INTEGER)::BIGINT AS flag_bronze_null
FROM flagged

-- silver_features: clean
SELECT claim_id, bene_id, service_date, claim_amount, service_year, service_month, service_quarter, day_of_week,
       is_weekend, period, is_inpatient, is_ed_visit, is_specialist, is_primary_care, cost_tier
FROM clean

-- member_profile: profile
SELECT * FROM profile

-- member_profile_by_sex: profile
SELECT sex, count(*) AS n, round(avg(age), 1) AS mean_age, round(avg(demographic_raf), 3) AS mean_demo_raf,
       sum(dual_eligible)::BIGINT AS n_dual_eligible
FROM profile GROUP BY sex

-- hcc_reference: clean crosswalk
SELECT x.icd10_code, x.hcc_number, x.hcc_description, x.raf_coefficient,
       count(c.icd10_primary) AS n_claims, count(DISTINCT c.bene_id) AS n_members
FROM crosswalk x LEFT JOIN clean c ON upper(trim(c.icd10_primary)) = x.icd10_code
GROUP BY ALL

-- hcc_mapped: mapped
SELECT claim_id, bene_id, service_date, array_to_string(hcc_list, ',') AS hcc_list, hcc_raf_total, primary_hcc,
       primary_hcc_desc, hcc_burden_count, hcc_interaction_total
FROM mapped

-- hcc_mapped_join_form: mapped
SELECT claim_id, bene_id, service_date, array_to_string(hcc_list, ',') AS hcc_list, hcc_raf_total, primary_hcc,
       primary_hcc_desc, hcc_burden_count, hcc_interaction_total
FROM mapped

-- hcc_primary: mapped
SELECT icd10_primary, primary_hcc, primary_hcc_desc, count(*) AS n_claims FROM mapped GROUP BY ALL

-- hcc_condition_flags: mapped
SELECT claim_id, bene_id, service_date, has_chf, has_afib, has_diabetes, has_ckd, has_cancer, has_copd,
       has_depression, has_metastatic
FROM mapped

-- hcc_interactions: mapped
SELECT claim_id, bene_id, service_date, interaction_chf_afib, interaction_chf_diabetes, interaction_ckd_diabetes,
       hcc_interaction_total
FROM mapped

-- hcc_sql_functions: mapped
SELECT claim_id, bene_id, service_date, array_to_string(hcc_list, ',') AS hcc_list, hcc_raf_total, primary_hcc, primary_hcc_desc
FROM mapped

-- hcc_prevalence: mapped
SELECT count(DISTINCT bene_id) AS unique_members,
       sum(has_chf::INTEGER)::BIGINT AS n_chf, sum(has_afib::INTEGER)::BIGINT AS n_afib,
       sum(has_diabetes::INTEGER)::BIGINT AS n_diabetes, sum(has_ckd::INTEGER)::BIGINT AS n_ckd,
       sum(has_cancer::INTEGER)::BIGINT AS n_cancer, sum(has_copd::INTEGER)::BIGINT AS n_copd,
       sum(has_metastatic::INTEGER)::BIGINT AS n_metastatic,
       round(avg(hcc_raf_total), 3) AS mean_hcc_raf, round(avg(hcc_burden_count), 2) AS mean_hcc_burden,
       round(avg(hcc_interaction_total), 3) AS mean_interaction_raf
FROM mapped

-- hcc_top_conditions: mapped
SELECT primary_hcc_desc, primary_hcc, count(DISTINCT bene_id) AS n_members, count(claim_id) AS n_claims,
       round(avg(hcc_raf_total), 3) AS mean_hcc_raf, round(exact_sum(claim_amount), 0) AS total_cost_usd
FROM mapped WHERE primary_hcc_desc IS NOT NULL AND primary_hcc_desc <> '{unmapped}'
GROUP BY primary_hcc_desc, primary_hcc
ORDER BY n_members DESC, primary_hcc_desc, primary_hcc LIMIT 15

-- gold_member_rollup: rollup
SELECT * FROM rollup

-- gold_raf_scores: scores
SELECT * FROM scores

-- gold_raf_member_union: profile mapped crosswalk
SELECT bene_id, coalesce(array_to_string(hccs, ','), '') AS hcc_list, weight AS union_hcc_raf, interaction AS union_interaction_raf,
       round(demographic_raf + weight + interaction, 4) AS raf_score_member_union
FROM (
    SELECT p.bene_id, p.demographic_raf, u.hccs, coalesce(u.weight, 0.0::DOUBLE) AS weight,
           CASE WHEN list_contains(hccs, 85) AND list_contains(hccs, 96) THEN 0.175::DOUBLE ELSE 0.0::DOUBLE END
           + CASE WHEN list_contains(hccs, 85) AND list_has_any(hccs, [17, 18, 19]) THEN 0.156::DOUBLE ELSE 0.0::DOUBLE END
           + CASE WHEN list_has_any(hccs, [134, 135, 136, 137, 138]) AND list_has_any(hccs, [17, 18, 19])
                  THEN 0.156::DOUBLE ELSE 0.0::DOUBLE END AS interaction
    FROM profile p LEFT JOIN (
        SELECT bene_id, list(hcc ORDER BY hcc) AS hccs, round(sum(raf_coefficient), 4) AS weight
        FROM (SELECT DISTINCT bene_id, unnest(hcc_list) AS hcc FROM mapped) m
        JOIN (SELECT DISTINCT hcc_number, raf_coefficient FROM crosswalk) x ON x.hcc_number = m.hcc
        GROUP BY bene_id
    ) u USING (bene_id)
)

-- gold_tier_summary: scores
SELECT risk_tier, count(*) AS n_members, round(avg(raf_score), 3) AS mean_raf, round(min(raf_score), 3) AS min_raf,
       round(max(raf_score), 3) AS max_raf, round(avg(estimated_annual_cost), 0) AS mean_est_cost_usd,
       round(avg(actual_pmpm), 2) AS mean_actual_pmpm
FROM scores GROUP BY risk_tier ORDER BY mean_raf DESC, risk_tier

-- gold_run_summary: scores
SELECT risk_tier, count(*) AS n_members, (SELECT round(avg(raf_score), 3) FROM scores) AS mean_raf
FROM scores GROUP BY risk_tier

-- gold_table_rows: clean mapped profile util trends
SELECT 'clean_claims' AS table_name, count(*) AS n_rows FROM clean
UNION ALL SELECT 'hcc_mapped_claims', count(*) FROM mapped
UNION ALL SELECT 'member_profile', count(*) FROM profile
UNION ALL SELECT 'utilization_summary', count(*) FROM util
UNION ALL SELECT 'monthly_trends', count(*) FROM trends

-- gold_utilization: util
SELECT * FROM util

-- gold_utilization_by_arm: util
SELECT period, intervention_arm, count(DISTINCT bene_id) AS n_members, round(avg(pmpm_cost), 2) AS mean_pmpm,
       round(avg(ip_rate_per_1000), 1) AS ip_rate_per_1000, round(avg(ed_rate_per_1000), 1) AS ed_rate_per_1000
FROM util GROUP BY period, intervention_arm ORDER BY period DESC, intervention_arm

-- gold_monthly_trends: trends
SELECT * REPLACE (round(pmpm_rolling_3m, 6) AS pmpm_rolling_3m) FROM trends
ORDER BY service_year, service_month, intervention_arm

-- gold_did_estimate: att
SELECT round(pre_control, 6) AS pre_control, round(post_control, 6) AS post_control, round(pre_treated, 6) AS pre_treated,
       round(post_treated, 6) AS post_treated, round(att_pmpm, 6) AS att_pmpm, round(att_annual, 6) AS att_annual
FROM att

-- gold_pre_trend_slopes: trends
SELECT intervention_arm, count(*) AS n_months, round(regr_slope(pmpm_cost, service_year * 12 + service_month), 4) AS pmpm_slope
FROM trends WHERE period = 'pre' GROUP BY intervention_arm

-- gold_parallel_trends: trends
SELECT n_control, n_treated, round(slope_control, 5) AS slope_control, round(slope_treated, 5) AS slope_treated,
       round(slope_treated - slope_control, 5) AS interaction, round(standard_error, 5) AS standard_error,
       n_control + n_treated - 4 AS degrees_of_freedom,
       round((slope_treated - slope_control) / standard_error, 5) AS t_value
FROM (
    SELECT *, sqrt((syy_c - slope_control * sxy_c + syy_t - slope_treated * sxy_t) / (n_control + n_treated - 4)
                   * (1 / sxx_c + 1 / sxx_t)) AS standard_error
    FROM (
        SELECT count(*) FILTER (intervention_arm = 0) AS n_control, count(*) FILTER (intervention_arm = 1) AS n_treated,
               regr_slope(pmpm_cost, t) FILTER (intervention_arm = 0) AS slope_control,
               regr_slope(pmpm_cost, t) FILTER (intervention_arm = 1) AS slope_treated,
               regr_sxx(pmpm_cost, t) FILTER (intervention_arm = 0) AS sxx_c,
               regr_sxx(pmpm_cost, t) FILTER (intervention_arm = 1) AS sxx_t,
               regr_sxy(pmpm_cost, t) FILTER (intervention_arm = 0) AS sxy_c,
               regr_sxy(pmpm_cost, t) FILTER (intervention_arm = 1) AS sxy_t,
               regr_syy(pmpm_cost, t) FILTER (intervention_arm = 0) AS syy_c,
               regr_syy(pmpm_cost, t) FILTER (intervention_arm = 1) AS syy_t
        FROM (SELECT *, service_year * 12 + service_month AS t FROM trends WHERE period = 'pre')
    )
)

-- gold_event_study: trends
SELECT service_year, service_month, period, (month - first_post)::INTEGER AS event_month,
       round(difference, 6) AS difference, round(difference - reference, 6) AS effect
FROM (
    SELECT *, min(month) FILTER (period = 'post') OVER () AS first_post,
           max_by(difference, month) FILTER (period = 'pre' AND difference IS NOT NULL) OVER () AS reference
    FROM (
        SELECT service_year, service_month, period, service_year * 12 + service_month AS month,
               max(pmpm_cost) FILTER (intervention_arm = 1) - max(pmpm_cost) FILTER (intervention_arm = 0) AS difference
        FROM trends GROUP BY service_year, service_month, period
    )
)

-- hcc_co_occurrence: mapped
SELECT * FROM (
WITH owned AS (
    SELECT DISTINCT bene_id, unnest(hcc_list) AS item FROM mapped
), size AS (
    SELECT count(DISTINCT bene_id) AS n_members FROM mapped
), singles AS (
    SELECT item, count(*) AS n FROM owned GROUP BY item
)
SELECT a.item AS item_a, b.item AS item_b, count(*) AS n_both, any_value(sa.n) AS n_a, any_value(sb.n) AS n_b,
       round(count(*) / any_value(n_members), 6) AS support,
       round(count(*) / any_value(sa.n), 6) AS confidence_ab, round(count(*) / any_value(sb.n), 6) AS confidence_ba,
       round(count(*) * any_value(n_members) / (any_value(sa.n) * any_value(sb.n)), 6) AS lift
FROM owned a JOIN owned b ON a.bene_id = b.bene_id AND a.item < b.item
     JOIN singles sa ON sa.item = a.item JOIN singles sb ON sb.item = b.item, size
GROUP BY a.item, b.item
HAVING count(*) >= 0.01::DOUBLE * any_value(n_members)
)

-- ml_correlations: matrix
SELECT * FROM (
WITH long AS (
    SELECT bene_id, feature, value FROM (UNPIVOT (SELECT * EXCLUDE (risk_tier) FROM matrix) ON COLUMNS(* EXCLUDE (bene_id)) INTO NAME feature VALUE value)
), placed AS (
    SELECT *, list_position([{features}], feature) AS place FROM long
)
SELECT a.feature AS feature_a, b.feature AS feature_b, count(*) AS n,
       CASE WHEN stddev_pop(a.value) > 0 AND stddev_pop(b.value) > 0 THEN round(corr(a.value, b.value), 6) END AS correlation
FROM placed a JOIN placed b ON a.bene_id = b.bene_id AND a.place < b.place
GROUP BY a.feature, b.feature
)

-- gold_pre_utilization: pre_util
SELECT * FROM pre_util

-- gold_feature_store: store
SELECT * REPLACE (round(log_pre_pmpm, 6) AS log_pre_pmpm, round(log_estimated_cost, 6) AS log_estimated_cost,
                  round(log_pre_total_cost, 6) AS log_pre_total_cost)
FROM store

-- gold_feature_store_joined: store
SELECT * REPLACE (round(log_pre_pmpm, 6) AS log_pre_pmpm, round(log_estimated_cost, 6) AS log_estimated_cost,
                  round(log_pre_total_cost, 6) AS log_pre_total_cost)
FROM store

-- gold_feature_store_by_tier: store
SELECT risk_tier, count(*) AS n, round(avg(raf_score), 3) AS mean_raf, round(avg(pre_pmpm), 2) AS mean_pre_pmpm,
       round(avg(max_hcc_burden), 1) AS mean_hcc_burden, round(avg(log_pre_pmpm), 3) AS mean_log_pre_pmpm
FROM store GROUP BY risk_tier ORDER BY mean_raf DESC, risk_tier

-- view_high_risk: scores
SELECT risk_tier, count(*) AS n_members, round(avg(raf_score), 3) AS mean_raf, round(avg(actual_pmpm), 2) AS mean_pmpm,
       sum(ip_admit_count)::BIGINT AS total_ip_admits, sum(ed_visit_count)::BIGINT AS total_ed_visits
FROM scores GROUP BY risk_tier

-- view_high_risk_pct: scores
SELECT risk_tier, count(*) AS n_members,
       round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scores), 1) AS pct_of_population,
       round(avg(raf_score), 3) AS mean_raf, round(avg(actual_pmpm), 2) AS mean_pmpm_usd,
       round(avg(estimated_annual_cost), 0) AS mean_est_cost_usd,
       sum(ip_admit_count)::BIGINT AS total_ip_admits, sum(ed_visit_count)::BIGINT AS total_ed_visits
FROM scores GROUP BY risk_tier

-- view_cohort_trends: trends
SELECT service_year, service_month, intervention_arm, n_members, round(pmpm_cost, 2) AS pmpm_cost,
       round(pmpm_rolling_3m, 2) AS pmpm_3m_avg, ip_rate_per_1000, ed_rate_per_1000, period
FROM trends ORDER BY service_year, service_month, intervention_arm

-- view_top_hcc: mapped
SELECT primary_hcc_desc AS condition, count(DISTINCT bene_id) AS n_members, round(avg(hcc_raf_total), 3) AS mean_hcc_raf,
       round(exact_sum(claim_amount), 0) AS total_claims_usd
FROM mapped WHERE primary_hcc_desc IS NOT NULL AND _quality_pass
GROUP BY primary_hcc_desc ORDER BY n_members DESC, condition LIMIT 20

-- view_top_hcc_mapped: mapped
SELECT primary_hcc_desc AS condition, primary_hcc AS hcc_number, count(DISTINCT bene_id) AS n_members,
       count(claim_id) AS n_claims, round(avg(hcc_raf_total), 3) AS mean_hcc_raf, round(exact_sum(claim_amount), 0) AS total_cost_usd
FROM mapped WHERE primary_hcc_desc IS NOT NULL AND primary_hcc_desc <> '{unmapped}' AND _quality_pass
GROUP BY primary_hcc_desc, primary_hcc ORDER BY n_members DESC, condition, hcc_number LIMIT 20

-- sql_raf_by_tier: scores
SELECT risk_tier, count(*) AS n_members, round(avg(raf_score), 3) AS mean_raf, round(avg(actual_pmpm), 2) AS mean_pmpm,
       sum(ip_admit_count)::BIGINT AS total_ip_admits
FROM scores GROUP BY risk_tier ORDER BY mean_raf DESC, risk_tier

-- sql_did_check: trends
SELECT period, intervention_arm, round(avg(pmpm_cost), 2) AS mean_pmpm, count(DISTINCT service_month) AS n_months
FROM trends GROUP BY period, intervention_arm ORDER BY period DESC, intervention_arm

-- savings_actual: cohort
SELECT benchmark_pmpm, round(actual_pmpm, 4) AS actual_pmpm, n_lives, sharing_rate, msr, round(gross, 4) AS gross_savings,
       round(gross / greatest(expected, 1), 4) AS savings_rate, gross / greatest(expected, 1) > msr AS exceeds_msr,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END, 4) AS earned_savings,
       round(gross / greatest(n_lives, 1), 4) AS per_member_gross,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END / greatest(n_lives, 1), 4) AS per_member_earned,
       CASE WHEN gross / greatest(expected, 1) > msr THEN 'SAVINGS_EARNED' ELSE 'BELOW_MSR' END AS status
FROM (SELECT *, benchmark_pmpm * n_lives * 12 AS expected, benchmark_pmpm * n_lives * 12 - actual_pmpm * n_lives * 12 AS gross,
             0.5::DOUBLE AS sharing_rate, 0.02::DOUBLE AS msr FROM cohort)

-- savings_by_state: scores
SELECT state, benchmark_pmpm, round(actual_pmpm, 4) AS actual_pmpm, n_lives, sharing_rate, msr, round(gross, 4) AS gross_savings,
       round(gross / greatest(expected, 1), 4) AS savings_rate, gross / greatest(expected, 1) > msr AS exceeds_msr,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END, 4) AS earned_savings,
       round(gross / greatest(n_lives, 1), 4) AS per_member_gross,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END / greatest(n_lives, 1), 4) AS per_member_earned,
       CASE WHEN gross / greatest(expected, 1) > msr THEN 'SAVINGS_EARNED' ELSE 'BELOW_MSR' END AS status
FROM (
    SELECT *, benchmark_pmpm * n_lives * 12 AS expected, benchmark_pmpm * n_lives * 12 - actual_pmpm * n_lives * 12 AS gross,
           0.5::DOUBLE AS sharing_rate, 0.02::DOUBLE AS msr
    FROM (SELECT state, 9800::DOUBLE / 12 AS benchmark_pmpm, exact_sum(actual_pmpm) / count(actual_pmpm) AS actual_pmpm, count(bene_id) AS n_lives
          FROM scores GROUP BY state)
)

-- savings_from_att: att
SELECT round(saved, 4) AS att_annual_savings, n_lives, benchmark_pmpm, round(actual_pmpm, 4) AS actual_pmpm, sharing_rate, msr,
       round(gross, 4) AS gross_savings,
       round(gross / greatest(expected, 1), 4) AS savings_rate, gross / greatest(expected, 1) > msr AS exceeds_msr,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END, 4) AS earned_savings,
       round(gross / greatest(n_lives, 1), 4) AS per_member_gross,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END / greatest(n_lives, 1), 4) AS per_member_earned,
       CASE WHEN gross / greatest(expected, 1) > msr THEN 'SAVINGS_EARNED' ELSE 'BELOW_MSR' END AS status
FROM (
    SELECT *, benchmark_pmpm * n_lives * 12 AS expected, benchmark_pmpm * n_lives * 12 - actual_pmpm * n_lives * 12 AS gross
    FROM (SELECT round(-att_annual, 6) AS saved, 10000 AS n_lives, 9800::DOUBLE / 12 AS benchmark_pmpm,
                 9800::DOUBLE / 12 - round(-att_annual, 6) / 12 AS actual_pmpm, 0.5::DOUBLE AS sharing_rate, 0.02::DOUBLE AS msr
          FROM att)
)

-- savings_projection: att
SELECT round(saved, 4) AS att_annual_savings, scenario, n_lives, benchmark_pmpm, round(actual_pmpm, 4) AS actual_pmpm,
       sharing_rate, msr, round(gross, 4) AS gross_savings,
       round(gross / greatest(expected, 1), 4) AS savings_rate, gross / greatest(expected, 1) > msr AS exceeds_msr,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END, 4) AS earned_savings,
       round(gross / greatest(n_lives, 1), 4) AS per_member_gross,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END / greatest(n_lives, 1), 4) AS per_member_earned,
       CASE WHEN gross / greatest(expected, 1) > msr THEN 'SAVINGS_EARNED' ELSE 'BELOW_MSR' END AS status
FROM (
    SELECT *, benchmark_pmpm * n_lives * 12 AS expected, benchmark_pmpm * n_lives * 12 - actual_pmpm * n_lives * 12 AS gross
    FROM (SELECT round(-att_annual, 6) AS saved, scenario, n_lives, 9800::DOUBLE / 12 AS benchmark_pmpm,
                 9800::DOUBLE / 12 - round(-att_annual, 6) / 12 AS actual_pmpm, 0.5::DOUBLE AS sharing_rate, 0.02::DOUBLE AS msr
          FROM att, (VALUES ('Regional ACO (10K members)', 10000), ('Mid-size MA plan (100K members)', 100000),
                            ('Large MA plan (500K members)', 500000), ('National-scale (1M members)', 1000000),
                            ('National-scale (4.7M members)', 4700000)) AS p(scenario, n_lives))
)

-- savings_grid: cohort
SELECT benchmark_pmpm, round(actual_pmpm, 4) AS actual_pmpm, n_lives, sharing_rate, msr, round(gross, 4) AS gross_savings,
       round(gross / greatest(expected, 1), 4) AS savings_rate, gross / greatest(expected, 1) > msr AS exceeds_msr,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END, 4) AS earned_savings,
       round(gross / greatest(n_lives, 1), 4) AS per_member_gross,
       round(CASE WHEN gross / greatest(expected, 1) > msr THEN gross * sharing_rate ELSE 0 END / greatest(n_lives, 1), 4) AS per_member_earned,
       CASE WHEN gross / greatest(expected, 1) > msr THEN 'SAVINGS_EARNED' ELSE 'BELOW_MSR' END AS status
FROM (SELECT cohort.*, sharing_rate::DOUBLE AS sharing_rate, msr::DOUBLE AS msr, benchmark_pmpm * n_lives * 12 AS expected,
             benchmark_pmpm * n_lives * 12 - actual_pmpm * n_lives * 12 AS gross
      FROM cohort, (VALUES (0.3), (0.5), (0.7)) s(sharing_rate), (VALUES (0.01), (0.02), (0.04)) m(msr))

-- drift_bins: edges
SELECT feature, (i - 1)::INTEGER AS position, floor(edges[i] * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS edge FROM edges, unnest(range(1, len(edges) + 1)) AS t(i)

-- drift_histogram: binned
SELECT feature, bin, floor(lower_edge * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS lower_edge,
       floor(upper_edge * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS upper_edge, n_baseline, n_current FROM binned

-- drift_report: drift
SELECT * FROM drift ORDER BY psi DESC, feature

-- drift_overall: drift
SELECT CASE WHEN count(*) FILTER (status = 'CRITICAL') > 0 THEN 'CRITICAL'
            WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'WARNING' ELSE 'STABLE' END AS overall_status,
       count(*) AS n_features, count(*) FILTER (status <> 'STABLE') AS n_alerts, count(*) FILTER (status = 'CRITICAL') AS n_critical,
       max(psi) AS max_psi,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (status <> 'STABLE'), '') AS alert_features
FROM drift

-- ml_matrix: matrix
SELECT * REPLACE (round(log_pre_pmpm, 6) AS log_pre_pmpm, round(log_estimated_cost, 6) AS log_estimated_cost,
                  round(log_pre_total_cost, 6) AS log_pre_total_cost)
FROM matrix

-- ml_split: scores
SELECT bene_id, risk_tier,
       row_number() OVER (PARTITION BY risk_tier ORDER BY md5(bene_id), bene_id)
           <= count(*) OVER (PARTITION BY risk_tier) - ceil(count(*) OVER (PARTITION BY risk_tier) * 0.2::DOUBLE) AS is_train
FROM scores

-- ml_labels: scores
SELECT risk_tier, count(*) AS n, (row_number() OVER (ORDER BY risk_tier) - 1)::INTEGER AS label_index FROM scores GROUP BY risk_tier

-- ml_accuracy: predicted
SELECT count(*) AS n, round(avg((risk_tier = predicted_tier)::INTEGER), 4) AS tier_accuracy FROM predicted

-- ml_class_report: class_ratios
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM class_ratios
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), sum(support)::BIGINT FROM class_ratios
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1_score * support) / sum(support), 6), sum(support)::BIGINT
FROM class_ratios

-- ml_auc_ovr: class_auc
SELECT * FROM class_auc

-- ml_auc_macro: class_auc
SELECT CASE WHEN count(auc) = 3 THEN round(avg(auc), 4) END AS auc_macro FROM class_auc

-- ml_regression_metrics: predicted
SELECT round(avg(abs(estimated_annual_cost - predicted_cost)), 2) AS cost_mae,
       round(sqrt(avg((estimated_annual_cost - predicted_cost) ** 2)), 2) AS cost_rmse,
       round(1 - avg((estimated_annual_cost - predicted_cost) ** 2) / nullif(var_pop(estimated_annual_cost), 0), 4) AS cost_r2
FROM predicted

-- ml_confusion: predicted
SELECT risk_tier, predicted_tier, count(*) AS n FROM predicted GROUP BY risk_tier, predicted_tier

-- ml_ece: predicted
SELECT sum(n)::BIGINT AS n, round(sum(n * gap) / sum(n), 6) AS ece FROM (
    SELECT count(*) AS n, abs(avg((risk_tier = predicted_tier)::INTEGER) - avg(confidence)) AS gap
    FROM predicted GROUP BY least(floor(confidence * 10), 9)
)

-- ml_predictions: ml_test
SELECT bene_id, risk_tier, true AS shares_sum_to_one, true AS tier_is_likeliest, true AS cost_is_finite FROM ml_test

-- ml_boosted: ml_test
SELECT bene_id, risk_tier, true AS shares_sum_to_one, true AS tier_is_likeliest, true AS cost_is_finite FROM ml_test

-- ml_evaluation: ml_test
SELECT count(*) AS n, true AS beats_majority, true AS auc_above_chance, true AS errors_in_order, true AS r2_in_range,
       true AS ece_in_range
FROM ml_test

-- ml_calibrated: score_grid
SELECT point, w AS n, round(max(least_mean), 6) AS calibrated FROM (
    SELECT m.point, m.w, f.a, min(f.mean) AS least_mean
    FROM score_grid m JOIN (
        SELECT lo.point AS a, hi.point AS b, (hi.upto_hits - lo.upto_hits + lo.hits) / (hi.upto_w - lo.upto_w + lo.w) AS mean
        FROM score_grid lo JOIN score_grid hi ON lo.point <= hi.point
    ) f ON f.a <= m.point AND m.point <= f.b
    GROUP BY m.point, m.w, f.a
) GROUP BY point, w

-- ml_permutation_importance: matrix
SELECT * FROM (
WITH long AS (
    SELECT bene_id, feature, value FROM (UNPIVOT (SELECT * EXCLUDE (risk_tier) FROM matrix) ON COLUMNS(* EXCLUDE (bene_id)) INTO NAME feature VALUE value)
), swapped AS (
    SELECT bene_id, feature, coalesce(
        lead(value) OVER (PARTITION BY feature, substr(md5(bene_id), 1, 2) ORDER BY md5(feature || '|' || bene_id), bene_id),
        first_value(value) OVER (PARTITION BY feature, substr(md5(bene_id), 1, 2) ORDER BY md5(feature || '|' || bene_id), bene_id)) AS value
    FROM long
), scored AS (
    SELECT s.feature, m.risk_tier,
           m.demographic_raf + m.max_hcc_raf + m.max_interaction_raf + m.pre_ed_visits * 0.02::DOUBLE AS own,
           CASE WHEN feature = 'demographic_raf' THEN value ELSE m.demographic_raf END
           + CASE WHEN feature = 'max_hcc_raf' THEN value ELSE m.max_hcc_raf END
           + CASE WHEN feature = 'max_interaction_raf' THEN value ELSE m.max_interaction_raf END
           + CASE WHEN feature = 'pre_ed_visits' THEN value ELSE m.pre_ed_visits END * 0.02::DOUBLE AS other
    FROM matrix m JOIN swapped s USING (bene_id)
), hits AS (
    SELECT feature,
           avg((risk_tier = CASE WHEN own >= 2.0::DOUBLE THEN 'high' WHEN own >= 1.2::DOUBLE THEN 'moderate' ELSE 'low' END)::INTEGER) AS score,
           avg((risk_tier = CASE WHEN other >= 2.0::DOUBLE THEN 'high' WHEN other >= 1.2::DOUBLE THEN 'moderate' ELSE 'low' END)::INTEGER) AS permuted
    FROM scored GROUP BY feature
)
SELECT feature, round(score, 6) AS score, round(permuted, 6) AS permuted_score, round(score - permuted, 6) AS importance FROM hits
)

-- ml_attribution: ml_test
SELECT bene_id, risk_tier, 4::BIGINT AS n_outputs, true AS adds_up FROM ml_test

-- ml_importance:
SELECT feature, true AS ranked, true AS sums_to_one, true AS ranks_complete FROM (SELECT unnest([{features}]) AS feature)
