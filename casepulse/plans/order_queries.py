"""The registered queries: every operator, report and measure over the order tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from casepulse.operators import (
    SeriesSpec,
    case_facts,
    changepoints,
    classify,
    cohort_baseline,
    cohort_matrix,
    cusum,
    drift_specs,
    early_processing,
    ewma_trend,
    latest_milestone,
    metric_series,
    open_at,
    portfolio_snapshot,
    portfolio_snapshots,
    profile,
    project,
    seasonal_profile,
    series_profile,
    shift_stats,
    shifts,
    trend_specs,
    ytd_rate,
)
from casepulse.plans import measures, reports
from casepulse.schemas import ALERT_CONFIG, batch_id_of, rounded
from casepulse.sources import indicator_config
from casepulse.sources.orders import ORDER_VOCABULARY, order_cases, order_milestones

Query = Callable[[SparkSession, str], DataFrame]

# The dates and names the queries and their SQL share.
AS_OF = date(2001, 6, 30)
SNAPSHOT = date(2001, 5, 31)
#: Month ends with a snapshot and the run that wrote each.
SNAPSHOTS = (
    (date(2001, 3, 31), datetime(2001, 4, 30, 6, 0, 0)),
    (date(2001, 4, 30), datetime(2001, 6, 30, 6, 0, 0)),
    (date(2001, 5, 31), datetime(2001, 6, 30, 6, 0, 0)),
)
#: All month ends of the years the tables cover.
HISTORY = [date(1995 + m // 12 + (m % 12 == 11), (m + 1) % 12 + 1, 1) - timedelta(days=1) for m in range(84)]
CURRENT_YEAR = 2001
#: A year of which December is known, so that nothing is left to forecast.
PAST_YEAR = 2000
START_YEAR = 1996
EXCLUDE = "%NOT SPECIFIED%"
BREAKS = (12, 36)
RUN_AT = datetime(2001, 6, 30, 6, 0, 0)
ALERTS = [("1-URGENT", 0.30, True), ("2-HIGH", 0.60, True), ("3-MEDIUM", 0.71, True), ("5-LOW", 0.5, False)]
TARGETS = [("1-URGENT", 3, 0.20, 0.25), ("2-HIGH", 12, 0.50, 0.65), ("3-MEDIUM", 18, 0.60, 0.80)]


def _cases(spark: SparkSession, folder: str) -> DataFrame:
    return order_cases(spark, folder)


def _series(spark: SparkSession, folder: str, specs) -> DataFrame:
    return metric_series(_cases(spark, folder), specs, start_year=START_YEAR)


def _drift_series(spark: SparkSession, folder: str) -> DataFrame:
    return _series(spark, folder, drift_specs(EXCLUDE))


def _case_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Days as DOUBLE: clients disagree on how to show a NULL among integers."""
    facts = case_facts(_cases(spark, folder), start_year=START_YEAR)
    return facts.withColumn("days_to_resolution", facts.days_to_resolution.cast("double"))


def _one_series(spec: SeriesSpec) -> Query:
    return lambda spark, folder: _series(spark, folder, [spec])


def _cusum(spark: SparkSession, folder: str) -> DataFrame:
    return cusum(_drift_series(spark, folder))


def _shifts(spark: SparkSession, folder: str, **options) -> DataFrame:
    return shifts(_drift_series(spark, folder), **options)


def _ewma(spark: SparkSession, folder: str) -> DataFrame:
    return ewma_trend(_series(spark, folder, trend_specs(EXCLUDE)))


def _one_ewma(metric: str) -> Query:
    return lambda spark, folder: ewma_trend(_series(spark, folder, [SeriesSpec(metric, "monthly", EXCLUDE)]))


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    return cohort_matrix(_cases(spark, folder), AS_OF, start_year=START_YEAR)


def _cohorts(spark: SparkSession, folder: str) -> DataFrame:
    return cohort_baseline(_matrix(spark, folder))


def _snapshot(spark: SparkSession, folder: str, day: date = SNAPSHOT) -> DataFrame:
    return portfolio_snapshot(
        _cases(spark, folder),
        order_milestones(spark, folder),
        day,
        vocabulary=ORDER_VOCABULARY,
        exclude_like=EXCLUDE,
    )


def _history(spark: SparkSession, folder: str, days: Sequence[date]) -> DataFrame:
    return portfolio_snapshots(
        _cases(spark, folder), order_milestones(spark, folder), days, vocabulary=ORDER_VOCABULARY, exclude_like=EXCLUDE
    )


def _case_state(spark: SparkSession, folder: str) -> DataFrame:
    still_open = open_at(_cases(spark, folder), SNAPSHOT)
    return classify(still_open, order_milestones(spark, folder), SNAPSHOT, ORDER_VOCABULARY)


def _early(spark: SparkSession, folder: str) -> DataFrame:
    return early_processing(
        _cases(spark, folder),
        order_milestones(spark, folder),
        SNAPSHOT,
        vocabulary=ORDER_VOCABULARY,
        exclude_like=EXCLUDE,
    )


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Several month ends, in one pass, with their runs, as the snapshot table holds them."""
    rows = _history(spark, folder, [day for day, _ in SNAPSHOTS])
    runs = [(day, batch_id_of(run_at), run_at) for day, run_at in SNAPSHOTS]
    return rows.join(spark.createDataFrame(runs, "snapshot_month date, batch_id string, computed_at timestamp"), "snapshot_month")


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return reports.snapshot_audit(_snapshots(spark, folder), batch_id_of(RUN_AT))


def _ytd(spark: SparkSession, folder: str, as_of: date | None = None) -> DataFrame:
    """Rates of all years; the projection looks at them from one day."""
    return ytd_rate(order_cases(spark, folder, as_of), start_year=START_YEAR, exclude_like=EXCLUDE)


def _projection(spark: SparkSession, folder: str, year: int = CURRENT_YEAR) -> DataFrame:
    return project(_ytd(spark, folder, AS_OF), year)


def _rag(spark: SparkSession, folder: str, year: int = CURRENT_YEAR) -> DataFrame:
    alerts = spark.createDataFrame(ALERTS, ALERT_CONFIG)
    return measures.projection_rag(_projection(spark, folder, year), alerts)


def _rag_config(spark: SparkSession, folder: str) -> DataFrame:
    return measures.projection_rag(
        _projection(spark, folder),
        indicator_config(spark, TARGETS),
        target_column="target_amber",
        active_column=None,
    )


QUERIES: dict[str, Query] = {
    "case_facts": _case_facts,
    "case_profile": lambda s, d: profile(_cases(s, d), distinct=["indicator"], ranges=["start_date"]),
    "series_frist_pct_monthly": _one_series(SeriesSpec("frist_pct", "monthly")),
    "series_tidsbruk_monthly": _one_series(SeriesSpec("tidsbruk", "monthly")),
    "series_prod_diff_monthly": _one_series(SeriesSpec("prod_diff", "monthly", EXCLUDE)),
    "series_frist_pct_weekly": _one_series(SeriesSpec("frist_pct", "weekly", EXCLUDE)),
    "series_prod_diff_weekly": _one_series(SeriesSpec("prod_diff", "weekly", EXCLUDE)),
    "series_all": _drift_series,
    "series_profile": lambda s, d: series_profile(_drift_series(s, d)),
    "ewma_frist_pct": _one_ewma("frist_pct"),
    "ewma_duration_monthly": _one_ewma("tidsbruk"),
    "ewma_prod_diff": _one_ewma("prod_diff"),
    "ewma_all": _ewma,
    "ewma_month_axis": lambda s, d: measures.month_axis(_ewma(s, d)).select("indicator", "metric", "month", "ewma_slow"),
    "ewma_measures": lambda s, d: measures.smoothed_measures(_ewma(s, d)),
    "trend_crosstab": lambda s, d: reports.trend_crosstab(_ewma(s, d)),
    "trend_active": lambda s, d: reports.active_trends(_ewma(s, d)),
    "trend_latest": lambda s, d: measures.latest_trend(_ewma(s, d)),
    "cusum_all": _cusum,
    "cusum_active": lambda s, d: reports.active_signals(_cusum(s, d)),
    "cusum_signal_count": lambda s, d: reports.signal_count(_cusum(s, d)),
    "cusum_latest_flag": lambda s, d: measures.latest_signal(_cusum(s, d)),
    "cusum_active_count": lambda s, d: measures.active_signal_count(_cusum(s, d)),
    "shift_stats": lambda s, d: shift_stats(_drift_series(s, d), BREAKS),
    "changepoints": lambda s, d: changepoints(_drift_series(s, d)),
    "changepoint_shifts": _shifts,
    "changepoint_shifts_log_n": lambda s, d: _shifts(s, d, penalty="log_n"),
    "largest_shifts": lambda s, d: reports.largest_shifts(_shifts(s, d)),
    "latest_changepoint": lambda s, d: measures.latest_changepoint(_shifts(s, d)),
    "cohort_matrix": _matrix,
    # The stored baseline is unrounded; rounding here compares it across engines.
    "cohort_baseline": lambda s, d: rounded(_cohorts(s, d), "pct_open_historical"),
    "cohort_week12": lambda s, d: reports.recent_cohorts(_cohorts(s, d)),
    "open_at": lambda s, d: open_at(_cases(s, d), SNAPSHOT),
    "latest_milestone": lambda s, d: latest_milestone(order_milestones(s, d), SNAPSHOT),
    "case_state": _case_state,
    "portfolio_snapshot": _snapshot,
    "portfolio_history": lambda s, d: _history(s, d, HISTORY),
    "early_processing": _early,
    "portfolio_shares": lambda s, d: measures.portfolio_shares(_snapshots(s, d)),
    "early_share": lambda s, d: measures.early_share(_snapshots(s, d), _cases(s, d)),
    "snapshot_audit": _audit,
    "ytd_rate": lambda s, d: rounded(_ytd(s, d), "ytd"),
    "seasonal_profile": lambda s, d: rounded(
        seasonal_profile(_ytd(s, d, AS_OF), CURRENT_YEAR), "mean_ratio", "std_ratio"
    ),
    "projection": _projection,
    "projection_summary": lambda s, d: reports.projection_summary(_projection(s, d), CURRENT_YEAR),
    "projection_measures": lambda s, d: measures.year_end_measures(_projection(s, d)),
    "projection_measures_december": lambda s, d: measures.year_end_measures(_projection(s, d, PAST_YEAR)),
    "projection_rag": _rag,
    "projection_rag_december": lambda s, d: _rag(s, d, PAST_YEAR),
    "projection_rag_config": _rag_config,
}
