"""Tunable thresholds, dates and rates. Every operator takes a ``Params``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Params:
    # Silver
    dedup_keys: tuple[str, ...] = ("claim_id", "bene_id", "service_date")
    max_claim_amount: float = 500_000.0
    cutover_year: int = 2023
    as_of: dt.date | None = None
    low_cost_below: float = 500.0
    medium_cost_below: float = 5_000.0
    min_age: int = 0
    max_age: int = 120
    aged_from: int = 65

    # Gold
    moderate_from: float = 1.2
    high_from: float = 2.0
    benchmark_pmpm: float = 9800 / 12
    msr: float = 0.02
    sharing_rate: float = 0.50
    rolling_rows: int = 3

    # Drift
    psi_bins: int = 10
    psi_warning: float = 0.10
    psi_critical: float = 0.25
    psi_epsilon: float = 1e-6

    # Model
    test_share: float = 0.20
    seed: int = 42
    n_trees: int = 300
    max_depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    calibration_folds: int = 3
    #: Decimals of the scores on which calibration is fitted.
    calibration_digits: int = 4

    def today(self) -> Column:
        """The date after which a service date counts as being in the future."""
        return F.current_date() if self.as_of is None else F.lit(self.as_of)
