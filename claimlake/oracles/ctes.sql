-- keyed_claims: slots
SELECT
    l_orderkey * 7 + l_linenumber AS _k,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 499 <> 0
         THEN 'CLM' || l_orderkey || '-' || l_linenumber END AS claim_id,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 503 <> 0
         THEN 'BNE' || CASE WHEN length(o_custkey::VARCHAR) > 8 THEN o_custkey::VARCHAR
                            ELSE lpad(o_custkey::VARCHAR, 8, '0') END END AS bene_id,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 521 = 0 THEN NULL
         WHEN (l_orderkey * 7 + l_linenumber) % 509 = 0 THEN 'bad-date'
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS service_date,
    year(l_shipdate)::INTEGER AS claim_year,
    month(l_shipdate)::INTEGER AS claim_month,
    CASE WHEN (l_partkey * 31 + l_suppkey) % 100 < 8 THEN 'ip_admit'
         WHEN (l_partkey * 31 + l_suppkey) % 100 < 20 THEN 'ed_visit'
         WHEN (l_partkey * 31 + l_suppkey) % 100 < 45 THEN 'specialist'
         WHEN (l_partkey * 31 + l_suppkey) % 100 < 85 THEN 'primary'
         ELSE 'lab' END AS service_type,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 487 <> 0
         THEN codes[(o_custkey * 7) % 51 + 1] END AS icd10_primary,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 479 <> 0
         THEN codes[(o_custkey * 7) % 51 + 1] || '|'
              || lower(codes[(o_custkey * 13 + l_linenumber) % 51 + 1]) || ' | '
              || codes[(o_custkey * 29) % 51 + 1] END AS icd10_codes,
    ['01', '06', '11', '38', '78', '93', '99'][l_suppkey % 7 + 1] AS provider_specialty,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 523 = 0 THEN 0.0::DOUBLE
         WHEN (l_orderkey * 7 + l_linenumber) % 541 = 0 THEN -l_extendedprice / 10
         WHEN (l_orderkey * 7 + l_linenumber) % 547 = 0 THEN l_extendedprice * 100
         WHEN (l_orderkey * 7 + l_linenumber) % 557 = 0 THEN NULL
         ELSE l_extendedprice / 10 END AS claim_amount,
    l_extendedprice / 10 * (1 - l_discount) AS allowed_amount,
    l_extendedprice / 10 * (1 - l_discount) * (1 - l_tax) AS paid_amount,
    ['HMO', 'PPO', 'PFFS', 'SNP'][o_custkey % 4 + 1] AS plan_type,
    CASE WHEN o_custkey % 7 < 3 THEN 1 ELSE 0 END AS intervention_arm
FROM lineitem
JOIN (
    SELECT o_orderkey, CASE WHEN o_custkey % 29 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders
) ON l_orderkey = o_orderkey, slots

-- raw_claims: keyed_claims
SELECT * EXCLUDE (_k), claim_id IS NULL OR bene_id IS NULL AS _bronze_null_flag FROM keyed_claims

-- raw_members:
SELECT
    'BNE' || CASE WHEN length(c_custkey::VARCHAR) > 8 THEN c_custkey::VARCHAR
                  ELSE lpad(c_custkey::VARCHAR, 8, '0') END AS bene_id,
    CASE WHEN c_custkey % 101 = 0 THEN NULL
         WHEN c_custkey % 211 = 0 THEN 130
         WHEN c_custkey % 223 = 0 THEN -1
         ELSE (60 + c_custkey % 41)::INTEGER END AS age,
    CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
    CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS dual_eligible,
    ['HMO', 'PPO', 'PFFS', 'SNP'][c_custkey % 4 + 1] AS plan_type,
    n_name AS state,
    strftime(DATE '1990-01-01' + (c_custkey % 1461)::INTEGER, '%Y-%m-%d') AS enrollment_date,
    CASE WHEN c_custkey % 7 < 3 THEN 1 ELSE 0 END AS intervention_arm
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey

-- batch_one: keyed_claims
SELECT * EXCLUDE (_k), '1' AS _batch_id FROM keyed_claims WHERE claim_year <= 1997

-- batch_two: keyed_claims
SELECT * EXCLUDE (_k) REPLACE (
    CASE WHEN claim_year <= 1997 THEN claim_amount * 1.1::DOUBLE ELSE claim_amount END AS claim_amount
), '2' AS _batch_id
FROM keyed_claims WHERE claim_year > 1997 OR _k % 10 = 0

-- typed: raw_claims
SELECT * REPLACE (
    TRY_CAST(service_date AS DATE) AS service_date,
    year(TRY_CAST(service_date AS DATE))::INTEGER AS claim_year,
    month(TRY_CAST(service_date AS DATE))::INTEGER AS claim_month
) FROM raw_claims

-- deduped: typed
SELECT * EXCLUDE (_rank) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY claim_id, bene_id, service_date
        ORDER BY paid_amount DESC NULLS LAST, claim_amount DESC NULLS LAST, allowed_amount DESC NULLS LAST,
                 {tie} DESC
    ) AS _rank FROM typed
) WHERE _rank = 1

-- flagged: deduped
SELECT *,
    claim_id IS NULL AS flag_null_claim_id,
    bene_id IS NULL AS flag_null_bene_id,
    claim_amount < 0 AS flag_negative_amount,
    claim_amount = 0 AS flag_zero_amount,
    claim_amount > 500000 AS flag_excessive_amount,
    service_date > DATE '2001-06-30' AS flag_future_date,
    service_date IS NULL AS flag_null_service_date,
    icd10_primary IS NULL AS flag_null_icd10,
    _bronze_null_flag AS flag_bronze_null,
    NOT (claim_id IS NULL OR bene_id IS NULL OR claim_amount < 0 OR claim_amount = 0
         OR claim_amount > 500000 OR service_date > DATE '2001-06-30' OR service_date IS NULL
         OR icd10_primary IS NULL OR _bronze_null_flag) AS _quality_pass
FROM deduped

-- clean: flagged
SELECT *,
    year(service_date)::INTEGER AS service_year,
    month(service_date)::INTEGER AS service_month,
    quarter(service_date)::INTEGER AS service_quarter,
    (dayofweek(service_date) + 1)::INTEGER AS day_of_week,
    dayofweek(service_date) IN (0, 6) AS is_weekend,
    CASE WHEN year(service_date) >= 1998 THEN 'post' ELSE 'pre' END AS period,
    service_type = 'ip_admit' AS is_inpatient,
    service_type = 'ed_visit' AS is_ed_visit,
    service_type = 'specialist' AS is_specialist,
    service_type = 'primary' AS is_primary_care,
    CASE WHEN claim_amount < 500 THEN 'low' WHEN claim_amount < 5000 THEN 'medium' ELSE 'high' END AS cost_tier
FROM flagged

-- passing: clean
SELECT * FROM clean WHERE _quality_pass

-- claim_hccs: passing crosswalk
SELECT claim_id, bene_id, service_date,
       list(hcc_number ORDER BY hcc_number) AS hcc_list,
       round(sum(raf_coefficient), 4) AS hcc_raf_total
FROM (
    SELECT DISTINCT claim_id, bene_id, service_date, hcc_number, raf_coefficient
    FROM (SELECT claim_id, bene_id, service_date, unnest(string_split(icd10_codes, '|')) AS code FROM passing) c
    JOIN crosswalk ON upper(trim(code)) = icd10_code
)
GROUP BY ALL

-- listed: passing claim_hccs crosswalk
SELECT p.*,
       coalesce(h.hcc_list, []::INTEGER[]) AS hcc_list,
       coalesce(h.hcc_raf_total, 0.0::DOUBLE) AS hcc_raf_total,
       x.hcc_number AS primary_hcc,
       CASE WHEN p.icd10_primary <> '' THEN coalesce(x.hcc_description, '{unmapped}') END AS primary_hcc_desc
FROM passing p
LEFT JOIN claim_hccs h USING (claim_id, bene_id, service_date)
LEFT JOIN crosswalk x ON x.icd10_code = upper(trim(p.icd10_primary))

-- conditioned: listed
SELECT *,
       len(hcc_list)::INTEGER AS hcc_burden_count,
       list_contains(hcc_list, 85) AS has_chf,
       list_contains(hcc_list, 96) AS has_afib,
       list_has_any(hcc_list, [17, 18, 19]) AS has_diabetes,
       list_has_any(hcc_list, [134, 135, 136, 137, 138]) AS has_ckd,
       list_has_any(hcc_list, [8, 9, 11, 12]) AS has_cancer,
       list_contains(hcc_list, 111) AS has_copd,
       list_contains(hcc_list, 58) AS has_depression,
       list_contains(hcc_list, 8) AS has_metastatic
FROM listed

-- interacting: conditioned
SELECT *,
       CASE WHEN has_chf AND has_afib THEN 0.175::DOUBLE ELSE 0.0::DOUBLE END AS interaction_chf_afib,
       CASE WHEN has_chf AND has_diabetes THEN 0.156::DOUBLE ELSE 0.0::DOUBLE END AS interaction_chf_diabetes,
       CASE WHEN has_ckd AND has_diabetes THEN 0.156::DOUBLE ELSE 0.0::DOUBLE END AS interaction_ckd_diabetes
FROM conditioned

-- mapped: interacting
SELECT *, interaction_chf_afib + interaction_chf_diabetes + interaction_ckd_diabetes AS hcc_interaction_total
FROM interacting

-- profile: raw_members demographic
SELECT m.* REPLACE (TRY_CAST(m.enrollment_date AS DATE) AS enrollment_date),
       coalesce(d.weight, 0.45::DOUBLE) AS demographic_raf,
       (floor(m.age / 5.0) * 5)::INTEGER AS age_bracket,
       m.age >= 65 AS is_aged,
       m.age < 0 OR m.age > 120 AS flag_invalid_age,
       m.sex IS NULL AS flag_null_sex
FROM raw_members m
LEFT JOIN demographic d
  ON d.sex = m.sex AND d.bracket = 65 + 5 * floor((greatest(65, least(95, m.age)) - 65 + 2.5) / 5) AND m.age IS NOT NULL

-- rollup: mapped
SELECT bene_id,
       max(hcc_burden_count) AS max_hcc_burden,
       max(hcc_raf_total) AS max_hcc_raf,
       max(hcc_interaction_total) AS max_interaction_raf,
       bool_or(has_chf) AS has_chf, bool_or(has_afib) AS has_afib,
       bool_or(has_diabetes) AS has_diabetes, bool_or(has_ckd) AS has_ckd,
       bool_or(has_cancer) AS has_cancer, bool_or(has_copd) AS has_copd,
       bool_or(has_depression) AS has_depression, bool_or(has_metastatic) AS has_metastatic,
       exact_sum(claim_amount) AS total_claim_amount,
       count(claim_id) AS total_claims,
       sum(is_inpatient::INTEGER)::BIGINT AS ip_admit_count,
       sum(is_ed_visit::INTEGER)::BIGINT AS ed_visit_count,
       count(DISTINCT service_year * 100 + service_month) FILTER (period = 'pre') AS pre_months,
       count(DISTINCT service_year * 100 + service_month) FILTER (period = 'post') AS post_months,
       exact_sum(claim_amount) FILTER (period = 'pre') AS pre_total_cost,
       exact_sum(claim_amount) FILTER (period = 'post') AS post_total_cost
FROM mapped GROUP BY bene_id

-- joined_scores: profile rollup
SELECT p.*,
       r.* EXCLUDE (bene_id) REPLACE (
           coalesce(max_hcc_burden, 0) AS max_hcc_burden,
           coalesce(max_hcc_raf, 0.0::DOUBLE) AS max_hcc_raf,
           coalesce(max_interaction_raf, 0.0::DOUBLE) AS max_interaction_raf,
           coalesce(total_claim_amount, 0.0::DOUBLE) AS total_claim_amount,
           coalesce(total_claims, 0) AS total_claims,
           coalesce(ip_admit_count, 0) AS ip_admit_count,
           coalesce(ed_visit_count, 0) AS ed_visit_count
       ),
       demographic_raf + coalesce(max_hcc_raf, 0.0::DOUBLE) + coalesce(max_interaction_raf, 0.0::DOUBLE) AS raf_score
FROM profile p LEFT JOIN rollup r USING (bene_id)

-- scores: joined_scores
SELECT *,
       CASE WHEN raf_score >= 2.0::DOUBLE THEN 'high' WHEN raf_score >= 1.2::DOUBLE THEN 'moderate' ELSE 'low' END AS risk_tier,
       raf_score * (9800::DOUBLE / 12) * 12 AS estimated_annual_cost,
       total_claim_amount / greatest(coalesce(pre_months + post_months, 1), 1) AS actual_pmpm,
       pre_total_cost / greatest(coalesce(pre_months, 1), 1) AS pre_pmpm,
       post_total_cost / greatest(coalesce(post_months, 1), 1) AS post_pmpm
FROM joined_scores

-- util_sums: passing
SELECT bene_id, period, intervention_arm,
       count(DISTINCT service_date) AS service_days,
       count(claim_id) AS total_claims,
       exact_sum(claim_amount) AS total_cost,
       exact_sum(allowed_amount) AS total_allowed,
       exact_sum(paid_amount) AS total_paid,
       sum(is_inpatient::INTEGER)::BIGINT AS ip_admits,
       sum(is_ed_visit::INTEGER)::BIGINT AS ed_visits,
       sum(is_specialist::INTEGER)::BIGINT AS specialist_visits,
       sum(is_primary_care::INTEGER)::BIGINT AS primary_care_visits,
       count(DISTINCT service_year * 100 + service_month) AS n_months
FROM passing GROUP BY bene_id, period, intervention_arm

-- util: util_sums
SELECT *,
       total_cost / greatest(n_months, 1) AS pmpm_cost,
       (ip_admits * 1000)::DOUBLE / greatest(n_months, 1) / 12 AS ip_rate_per_1000,
       (ed_visits * 1000)::DOUBLE / greatest(n_months, 1) / 12 AS ed_rate_per_1000
FROM util_sums

-- trend_sums: passing
SELECT service_year, service_month, intervention_arm,
       count(DISTINCT bene_id) AS n_members,
       exact_sum(claim_amount) AS total_cost,
       sum(is_inpatient::INTEGER)::BIGINT AS ip_admits,
       sum(is_ed_visit::INTEGER)::BIGINT AS ed_visits
FROM passing GROUP BY service_year, service_month, intervention_arm

-- trends: trend_sums
SELECT *,
       total_cost / greatest(n_members, 1) AS pmpm_cost,
       (ip_admits * 1000)::DOUBLE / greatest(n_members, 1) AS ip_rate_per_1000,
       (ed_visits * 1000)::DOUBLE / greatest(n_members, 1) AS ed_rate_per_1000,
       CASE WHEN service_year >= 1998 THEN 'post' ELSE 'pre' END AS period,
       avg(total_cost / greatest(n_members, 1)) OVER (
           PARTITION BY intervention_arm ORDER BY service_year, service_month
           ROWS BETWEEN 2 PRECEDING AND CURRENT ROW
       ) AS pmpm_rolling_3m
FROM trend_sums

-- did: trends
SELECT avg(pmpm_cost) FILTER (period = 'pre' AND intervention_arm = 0) AS pre_control,
       avg(pmpm_cost) FILTER (period = 'post' AND intervention_arm = 0) AS post_control,
       avg(pmpm_cost) FILTER (period = 'pre' AND intervention_arm = 1) AS pre_treated,
       avg(pmpm_cost) FILTER (period = 'post' AND intervention_arm = 1) AS post_treated
FROM trends

-- att: did
SELECT *, (post_treated - pre_treated) - (post_control - pre_control) AS att_pmpm,
       ((post_treated - pre_treated) - (post_control - pre_control)) * 12 AS att_annual
FROM did

-- pre_util: passing
SELECT bene_id,
       sum(is_inpatient::INTEGER)::BIGINT AS pre_ip_admits,
       sum(is_ed_visit::INTEGER)::BIGINT AS pre_ed_visits,
       sum(is_specialist::INTEGER)::BIGINT AS pre_specialist_visits,
       sum(is_primary_care::INTEGER)::BIGINT AS pre_primary_visits,
       count(DISTINCT service_year * 100 + service_month) AS pre_n_months,
       exact_sum(claim_amount) AS pre_total_cost,
       exact_sum(claim_amount) / count(claim_amount) AS pre_avg_claim,
       max(claim_amount) AS pre_max_claim,
       exact_sum(claim_amount) / greatest(count(DISTINCT service_year * 100 + service_month), 1) AS pre_pmpm,
       sum(is_inpatient::INTEGER)::DOUBLE / greatest(count(DISTINCT service_year * 100 + service_month), 1) AS pre_ip_rate,
       sum(is_ed_visit::INTEGER)::DOUBLE / greatest(count(DISTINCT service_year * 100 + service_month), 1) AS pre_ed_rate
FROM passing WHERE period = 'pre' GROUP BY bene_id

-- store: scores pre_util
SELECT s.bene_id, coalesce(s.age, 0) AS age, (s.sex = 'M')::INTEGER AS sex_male, s.dual_eligible, s.demographic_raf,
       coalesce(s.age_bracket, 0) AS age_bracket,
       s.max_hcc_burden, s.max_hcc_raf, s.max_interaction_raf,
       coalesce(s.has_chf::INTEGER, 0) AS has_chf, coalesce(s.has_afib::INTEGER, 0) AS has_afib,
       coalesce(s.has_diabetes::INTEGER, 0) AS has_diabetes, coalesce(s.has_ckd::INTEGER, 0) AS has_ckd,
       coalesce(s.has_cancer::INTEGER, 0) AS has_cancer, coalesce(s.has_copd::INTEGER, 0) AS has_copd,
       coalesce(s.has_depression::INTEGER, 0) AS has_depression, coalesce(s.has_metastatic::INTEGER, 0) AS has_metastatic,
       coalesce(u.pre_ip_admits, 0) AS pre_ip_admits, coalesce(u.pre_ed_visits, 0) AS pre_ed_visits,
       coalesce(u.pre_specialist_visits, 0) AS pre_specialist_visits, coalesce(u.pre_primary_visits, 0) AS pre_primary_visits,
       coalesce(u.pre_n_months, 0) AS pre_n_months, coalesce(u.pre_total_cost, 0.0::DOUBLE) AS pre_total_cost,
       coalesce(u.pre_avg_claim, 0.0::DOUBLE) AS pre_avg_claim, coalesce(u.pre_max_claim, 0.0::DOUBLE) AS pre_max_claim,
       coalesce(u.pre_pmpm, 0.0::DOUBLE) AS pre_pmpm, coalesce(u.pre_ip_rate, 0.0::DOUBLE) AS pre_ip_rate,
       coalesce(u.pre_ed_rate, 0.0::DOUBLE) AS pre_ed_rate,
       s.raf_score, s.estimated_annual_cost, s.actual_pmpm,
       ln(1 + coalesce(u.pre_pmpm, 0.0::DOUBLE)) AS log_pre_pmpm,
       ln(1 + s.estimated_annual_cost) AS log_estimated_cost,
       ln(1 + coalesce(u.pre_total_cost, 0.0::DOUBLE)) AS log_pre_total_cost,
       s.sex, s.state, s.risk_tier, s.intervention_arm
FROM scores s LEFT JOIN pre_util u USING (bene_id)

-- cohort: scores
SELECT 9800::DOUBLE / 12 AS benchmark_pmpm, coalesce(exact_sum(actual_pmpm) / count(actual_pmpm), 0.0::DOUBLE) AS actual_pmpm,
       count(bene_id) AS n_lives
FROM scores

-- snapshots: profile mapped
SELECT s.period AS snapshot, p.bene_id, p.demographic_raf,
       coalesce(max(hcc_burden_count), 0) AS max_hcc_burden,
       coalesce(max(hcc_raf_total), 0.0::DOUBLE) AS max_hcc_raf,
       coalesce(max(hcc_interaction_total), 0.0::DOUBLE) AS max_interaction_raf,
       coalesce(sum(is_inpatient::INTEGER), 0)::BIGINT AS pre_ip_admits,
       coalesce(sum(is_ed_visit::INTEGER), 0)::BIGINT AS pre_ed_visits,
       coalesce(exact_sum(claim_amount) / greatest(count(DISTINCT service_year * 100 + service_month), 1), 0.0::DOUBLE) AS pre_pmpm
FROM profile p CROSS JOIN (VALUES ('pre'), ('post')) s(period)
LEFT JOIN mapped m ON m.bene_id = p.bene_id AND m.period = s.period
GROUP BY s.period, p.bene_id, p.demographic_raf

-- scored_snapshots: snapshots
SELECT *, demographic_raf + max_hcc_raf + max_interaction_raf AS raf_score,
       (demographic_raf + max_hcc_raf + max_interaction_raf) * (9800::DOUBLE / 12) * 12 AS estimated_annual_cost
FROM snapshots

-- watched: scored_snapshots
SELECT snapshot, feature, value FROM (
    UNPIVOT (
        SELECT snapshot, raf_score, pre_pmpm, max_hcc_burden::DOUBLE AS max_hcc_burden, max_hcc_raf,
               pre_ip_admits::DOUBLE AS pre_ip_admits, pre_ed_visits::DOUBLE AS pre_ed_visits,
               estimated_annual_cost, demographic_raf
        FROM scored_snapshots
    ) ON COLUMNS(* EXCLUDE (snapshot)) INTO NAME feature VALUE value
)

-- edges: watched
SELECT feature, list_sort(list_distinct(list_transform(range(0, 11), lambda i:
           v[floor((len(v) - 1) * (i / 10::DOUBLE))::BIGINT + 1]
           + (v[ceil((len(v) - 1) * (i / 10::DOUBLE))::BIGINT + 1] - v[floor((len(v) - 1) * (i / 10::DOUBLE))::BIGINT + 1])
             * ((len(v) - 1) * (i / 10::DOUBLE) - floor((len(v) - 1) * (i / 10::DOUBLE)))))) AS edges
FROM (SELECT feature, list_sort(list(value)) AS v FROM watched WHERE snapshot = 'pre' AND value IS NOT NULL GROUP BY feature)

-- bins: edges
SELECT feature, bin::INTEGER AS bin, edges[bin] AS lower_edge, edges[bin + 1] AS upper_edge, bin = len(edges) - 1 AS is_last
FROM edges, unnest(range(1, len(edges))) AS t(bin)
WHERE len(edges) >= 2

-- binned: bins watched
SELECT b.feature, b.bin, b.lower_edge, b.upper_edge,
       count(*) FILTER (w.snapshot = 'pre') AS n_baseline,
       count(*) FILTER (w.snapshot = 'post') AS n_current
FROM bins b
LEFT JOIN watched w ON w.feature = b.feature AND w.value >= b.lower_edge
     AND (w.value < b.upper_edge OR (b.is_last AND w.value = b.upper_edge))
GROUP BY b.feature, b.bin, b.lower_edge, b.upper_edge

-- watched_totals: watched
SELECT feature, count(value) FILTER (snapshot = 'pre') AS n_baseline, count(value) FILTER (snapshot = 'post') AS n_current
FROM watched GROUP BY feature

-- psi: binned watched_totals
SELECT feature, round(sum((a - e) * ln(a / e)), 4) AS psi FROM (
    SELECT b.feature,
           CASE WHEN b.n_baseline = 0 THEN 1e-6::DOUBLE ELSE b.n_baseline::DOUBLE / greatest(t.n_baseline, 1) END AS e,
           CASE WHEN b.n_current = 0 THEN 1e-6::DOUBLE ELSE b.n_current::DOUBLE / greatest(t.n_current, 1) END AS a
    FROM binned b JOIN watched_totals t USING (feature)
) GROUP BY feature

-- drift: watched_totals psi
SELECT feature, coalesce(psi, 0.0::DOUBLE) AS psi,
       CASE WHEN psi > 0.25::DOUBLE THEN 'CRITICAL' WHEN psi > 0.10::DOUBLE THEN 'WARNING' ELSE 'STABLE' END AS status,
       n_baseline, n_current
FROM watched_totals LEFT JOIN psi USING (feature)

-- noisy: scores
SELECT bene_id, risk_tier, estimated_annual_cost, raf_score,
       ((substr(bene_id, 4)::BIGINT * 37) % 100 - 50)::DOUBLE / 100.0::DOUBLE AS noise
FROM scores

-- weighed: noisy
SELECT bene_id, risk_tier, estimated_annual_cost,
       estimated_annual_cost * (1 + noise / 5) AS predicted_cost,
       CASE WHEN raf_score + noise >= 2.0::DOUBLE THEN 'high' WHEN raf_score + noise >= 1.2::DOUBLE THEN 'moderate'
            ELSE 'low' END AS predicted_tier,
       1 / (0.05::DOUBLE + abs(raf_score + noise - 0.8::DOUBLE)) AS w_low,
       1 / (0.05::DOUBLE + abs(raf_score + noise - 1.6::DOUBLE)) AS w_moderate,
       1 / (0.05::DOUBLE + abs(raf_score + noise - 2.6::DOUBLE)) AS w_high
FROM noisy

-- predicted: weighed
SELECT bene_id, risk_tier, estimated_annual_cost, predicted_cost, predicted_tier,
       w_high / (w_high + w_low + w_moderate) AS prob_high,
       w_low / (w_high + w_low + w_moderate) AS prob_low,
       w_moderate / (w_high + w_low + w_moderate) AS prob_moderate,
       CASE predicted_tier WHEN 'high' THEN w_high WHEN 'low' THEN w_low ELSE w_moderate END
           / (w_high + w_low + w_moderate) AS confidence
FROM weighed

-- class_scores: predicted
SELECT class, risk_tier = class AS is_pos,
       CASE class WHEN 'high' THEN prob_high WHEN 'low' THEN prob_low ELSE prob_moderate END AS score
FROM predicted, (VALUES ('high'), ('low'), ('moderate')) c(class)

-- class_ranks: class_scores
SELECT class, is_pos,
       rank() OVER (PARTITION BY class ORDER BY score)
           + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0::DOUBLE AS mid_rank
FROM class_scores

-- class_auc: class_ranks
SELECT class, count(*) FILTER (is_pos) AS n_class, count(*) FILTER (NOT is_pos) AS n_rest,
       round((sum(mid_rank) FILTER (is_pos)
              - count(*) FILTER (is_pos)::DOUBLE * (count(*) FILTER (is_pos) + 1) / 2)
             / nullif(count(*) FILTER (is_pos)::DOUBLE * count(*) FILTER (NOT is_pos), 0), 6) AS auc
FROM class_ranks GROUP BY class

-- class_ratios: predicted
SELECT label,
       CASE WHEN claimed = 0 THEN 0.0::DOUBLE ELSE hits / claimed END AS precision,
       CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hits / support END AS recall,
       CASE WHEN support + claimed = 0 THEN 0.0::DOUBLE ELSE 2 * hits / (support + claimed) END AS f1_score,
       support
FROM (
    SELECT label, count(*) FILTER (risk_tier = label) AS support,
           count(*) FILTER (predicted_tier = label) AS claimed,
           count(*) FILTER (risk_tier = label AND predicted_tier = label) AS hits
    FROM predicted, (SELECT risk_tier AS label FROM predicted UNION SELECT predicted_tier FROM predicted) l
    GROUP BY label
)

-- half_years: keyed_claims
SELECT *, number::VARCHAR AS _batch_id FROM (
    SELECT * EXCLUDE (_k), (claim_year - 1992) * 2 + CASE WHEN claim_month > 6 THEN 2 ELSE 1 END AS number FROM keyed_claims
)

-- ml_test: scores
SELECT bene_id, risk_tier FROM (
    SELECT bene_id, risk_tier,
           row_number() OVER (PARTITION BY risk_tier ORDER BY md5(bene_id), bene_id)
               <= count(*) OVER (PARTITION BY risk_tier) - ceil(count(*) OVER (PARTITION BY risk_tier) * 0.2::DOUBLE) AS is_train
    FROM scores
) WHERE NOT is_train

-- score_grid: predicted
SELECT *, sum(w) OVER (ORDER BY point) AS upto_w, sum(hits) OVER (ORDER BY point) AS upto_hits FROM (
    SELECT round(prob_high, 2) AS point, count(*)::DOUBLE AS w, count(*) FILTER (risk_tier = 'high')::DOUBLE AS hits
    FROM predicted GROUP BY 1
)

-- matrix: store
SELECT bene_id, risk_tier, age::DOUBLE AS age, coalesce(sex_male, 0)::DOUBLE AS sex_male, dual_eligible::DOUBLE AS dual_eligible,
       demographic_raf, age_bracket::DOUBLE AS age_bracket, max_hcc_burden::DOUBLE AS max_hcc_burden, max_hcc_raf, max_interaction_raf,
       has_chf::DOUBLE AS has_chf, has_afib::DOUBLE AS has_afib, has_diabetes::DOUBLE AS has_diabetes, has_ckd::DOUBLE AS has_ckd,
       has_cancer::DOUBLE AS has_cancer, has_copd::DOUBLE AS has_copd, has_depression::DOUBLE AS has_depression,
       has_metastatic::DOUBLE AS has_metastatic, pre_ip_admits::DOUBLE AS pre_ip_admits, pre_ed_visits::DOUBLE AS pre_ed_visits,
       pre_specialist_visits::DOUBLE AS pre_specialist_visits, pre_primary_visits::DOUBLE AS pre_primary_visits,
       pre_n_months::DOUBLE AS pre_n_months, pre_total_cost, pre_avg_claim, pre_max_claim, pre_pmpm, pre_ip_rate, pre_ed_rate,
       raf_score, estimated_annual_cost, actual_pmpm, log_pre_pmpm,
       log_estimated_cost, log_pre_total_cost
FROM store
