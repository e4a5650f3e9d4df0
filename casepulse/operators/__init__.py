"""The analytic operators: DataFrame in, DataFrame out."""

from casepulse.operators.changepoint import changepoints, mark_segments, segment_series, shift_stats, shifts
from casepulse.operators.cohort import case_facts, cohort_baseline, cohort_matrix
from casepulse.operators.drift import cusum
from casepulse.operators.portfolio import (
    Vocabulary,
    classify,
    early_processing,
    latest_milestone,
    open_at,
    portfolio_snapshot,
    portfolio_snapshots,
    snapshot_month_end,
)
from casepulse.operators.profile import profile, series_profile
from casepulse.operators.projection import project, seasonal_profile, ytd_rate
from casepulse.operators.series import SeriesSpec, drift_specs, metric_series, trend_specs
from casepulse.operators.trend import TREND_THRESHOLDS, ewma, ewma_trend, trend

__all__ = [
    "SeriesSpec",
    "TREND_THRESHOLDS",
    "Vocabulary",
    "case_facts",
    "changepoints",
    "classify",
    "cohort_baseline",
    "cohort_matrix",
    "cusum",
    "drift_specs",
    "early_processing",
    "ewma",
    "ewma_trend",
    "latest_milestone",
    "mark_segments",
    "metric_series",
    "open_at",
    "portfolio_snapshot",
    "portfolio_snapshots",
    "profile",
    "project",
    "seasonal_profile",
    "segment_series",
    "series_profile",
    "shift_stats",
    "shifts",
    "snapshot_month_end",
    "trend",
    "trend_specs",
    "ytd_rate",
]
