"""Clinical code tables and column lists.

Everything here is a fixed value: results depend on these exact entries.
"""

from __future__ import annotations

from typing import NamedTuple


class Crosswalk(NamedTuple):
    icd10_code: str
    hcc_number: int
    hcc_description: str
    raf_coefficient: float


# Category number -> (description, coefficient, diagnosis codes).
CATEGORIES: dict[int, tuple[str, float, tuple[str, ...]]] = {
    85: ("Congestive Heart Failure", 0.323, ("I500", "I501", "I509")),
    96: ("Atrial Fibrillation / Flutter", 0.421, ("I480", "I481", "I489")),
    86: ("Acute MI", 0.218, ("I2109", "I2110")),
    107: ("Vascular Disease w/ Complications", 0.299, ("I7001", "I7011")),
    108: ("Vascular Disease", 0.178, ("I739", "I731")),
    18: ("T2DM with CKD", 0.302, ("E1140", "E1141", "E1142")),
    19: ("T2DM Without Complications", 0.118, ("E119", "E118")),
    17: ("T1DM Acute Complication", 0.302, ("E1010", "E1011")),
    138: ("CKD Stage 3", 0.071, ("N183",)),
    137: ("CKD Stage 4", 0.138, ("N184",)),
    136: ("CKD Stage 5", 0.143, ("N185",)),
    135: ("Renal Failure", 0.289, ("N19", "N189")),
    134: ("Dialysis Status", 0.289, ("Z992", "Z4901")),
    111: ("COPD", 0.245, ("J449", "J440", "J441")),
    110: ("Cystic Fibrosis / ILD", 0.335, ("J84189",)),
    8: ("Metastatic Cancer", 2.488, ("C7951", "C7952")),
    9: ("Lung / Severe Cancer", 0.899, ("C349", "C340")),
    11: ("Colorectal / Bladder Cancer", 0.439, ("C189", "C180")),
    12: ("Breast Cancer", 0.150, ("C509", "C500")),
    79: ("Seizure Disorders", 0.448, ("G409", "G400")),
    78: ("Parkinson's Disease", 0.406, ("G20",)),
    77: ("Multiple Sclerosis", 0.597, ("G35",)),
    40: ("Rheumatoid Arthritis", 0.455, ("M0500", "M0510")),
    58: ("Major Depression", 0.421, ("F329", "F330")),
    57: ("Schizophrenia", 0.625, ("F209", "F200")),
    22: ("Morbid Obesity", 0.178, ("E6601", "E6609")),
}

CROSSWALK: tuple[Crosswalk, ...] = tuple(
    Crosswalk(code, hcc, label, coefficient)
    for hcc, (label, coefficient, codes) in CATEGORIES.items()
    for code in codes
)

UNMAPPED_LABEL = "Unknown / Not Mapped"

# Demographic coefficient per sex for the brackets 65, 70, ... 95.
BRACKETS = (65, 70, 75, 80, 85, 90, 95)
DEMOGRAPHIC = {
    "F": (0.321, 0.382, 0.453, 0.521, 0.591, 0.658, 0.712),
    "M": (0.346, 0.401, 0.478, 0.549, 0.619, 0.685, 0.740),
}
DEMOGRAPHIC_DEFAULT = 0.45

# Condition flag -> category numbers that raise it.
CONDITIONS: dict[str, tuple[int, ...]] = {
    "has_chf": (85,),
    "has_afib": (96,),
    "has_diabetes": (17, 18, 19),
    "has_ckd": (134, 135, 136, 137, 138),
    "has_cancer": (8, 9, 11, 12),
    "has_copd": (111,),
    "has_depression": (58,),
    "has_metastatic": (8,),
}

# Interaction term -> (two flags that must both hold, weight).
INTERACTIONS: dict[str, tuple[str, str, float]] = {
    "interaction_chf_afib": ("has_chf", "has_afib", 0.175),
    "interaction_chf_diabetes": ("has_chf", "has_diabetes", 0.156),
    "interaction_ckd_diabetes": ("has_ckd", "has_diabetes", 0.156),
}

# Service flag -> service_type it stands for.
SERVICES: dict[str, str] = {
    "is_inpatient": "ip_admit",
    "is_ed_visit": "ed_visit",
    "is_specialist": "specialist",
    "is_primary_care": "primary",
}

# The 33 model features, in matrix order.
FEATURES: tuple[str, ...] = (
    "age", "sex_male", "dual_eligible", "demographic_raf", "age_bracket",
    "max_hcc_burden", "max_hcc_raf", "max_interaction_raf",
    "has_chf", "has_afib", "has_diabetes", "has_ckd",
    "has_cancer", "has_copd", "has_depression", "has_metastatic",
    "pre_ip_admits", "pre_ed_visits", "pre_specialist_visits", "pre_primary_visits",
    "pre_n_months", "pre_total_cost", "pre_avg_claim", "pre_max_claim",
    "pre_pmpm", "pre_ip_rate", "pre_ed_rate",
    "raf_score", "estimated_annual_cost", "actual_pmpm",
    "log_pre_pmpm", "log_estimated_cost", "log_pre_total_cost",
)

# Features that restate the labels (demographic and category weights, score,
# cost) or that also look at claims after the cut-over (burden, flags, PMPM).
LEAKING_FEATURES: tuple[str, ...] = (
    "demographic_raf", "max_hcc_burden", "max_hcc_raf", "max_interaction_raf",
    *CONDITIONS,
    "raf_score", "estimated_annual_cost", "actual_pmpm", "log_estimated_cost",
)
LEAK_FREE_FEATURES: tuple[str, ...] = tuple(f for f in FEATURES if f not in LEAKING_FEATURES)

# Features watched for drift by default.
DRIFT_FEATURES: tuple[str, ...] = (
    "raf_score", "pre_pmpm", "max_hcc_burden", "max_hcc_raf",
    "pre_ip_admits", "pre_ed_visits", "estimated_annual_cost", "demographic_raf",
)

# Populations for savings projections.
POPULATIONS: tuple[tuple[str, int], ...] = (
    ("Regional ACO (10K members)", 10_000),
    ("Mid-size MA plan (100K members)", 100_000),
    ("Large MA plan (500K members)", 500_000),
    ("National-scale (1M members)", 1_000_000),
    ("National-scale (4.7M members)", 4_700_000),
)

# Columns whose digest decides between claim lines of one key and equal amounts.
TIE_COLUMNS = ("service_type", "icd10_primary", "icd10_codes", "provider_specialty", "plan_type", "intervention_arm")
