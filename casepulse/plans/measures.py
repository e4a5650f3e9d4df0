"""The measures behind the dashboards, one row per key instead of one per filter context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casepulse.functions import period_start
from casepulse.operators.trend import FALLING, RISING
from casepulse.schemas import SERIES_KEY

# Fixed value: share of the target still shown amber.
AMBER_TOLERANCE = 0.95


def latest_signal(cusum_results: DataFrame) -> DataFrame:
    """Whether each series has a drift signal at its newest period."""
    return cusum_results.groupBy(*SERIES_KEY).agg(
        F.max("period").alias("latest_period"),
        F.max_by("signal", "period").alias("has_active_signal"),
    )


def active_signal_count(cusum_results: DataFrame) -> DataFrame:
    """Indicators with a signal at the newest period of each metric and granularity."""
    per_period = cusum_results.groupBy("metric", "granularity", "period").agg(
        F.count_distinct(F.when(F.col("signal"), F.col("indicator"))).alias("n")
    )
    return per_period.groupBy("metric", "granularity").agg(
        F.max("period").alias("latest_period"), F.max_by("n", "period").alias("active_signals")
    )


def month_axis(results: DataFrame, period: str = "period", alias: str = "month") -> DataFrame:
    """Monthly results with the first day of each period, the axis charts are drawn on."""
    return results.withColumn(alias, period_start(F.col(period)))


def latest_changepoint(changepoint_results: DataFrame) -> DataFrame:
    """Period and size of the newest shift of each series."""
    return changepoint_results.groupBy(*SERIES_KEY).agg(
        F.max("changepoint_period").alias("latest_changepoint_period"),
        F.max_by("shift_magnitude", "changepoint_period").alias("shift_magnitude"),
    )


def smoothed_measures(ewma_results: DataFrame) -> DataFrame:
    """The smoothed rate (slow and fast), duration and balance of each indicator and period."""

    def of(metric: str, name: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(name)))

    return ewma_results.groupBy("indicator", "period").agg(
        of("frist_pct", "ewma_slow").alias("ewma_slow_frist_pct"),
        of("frist_pct", "ewma_fast").alias("ewma_fast_frist_pct"),
        of("tidsbruk", "ewma_slow").alias("ewma_tidsbruk"),
        of("prod_diff", "ewma_slow").alias("ewma_prod_diff"),
    )


def latest_trend(ewma_results: DataFrame) -> DataFrame:
    """Direction at the newest period of each indicator and metric, and its code 1 / -1 / 0."""
    direction = F.col("trend_direction")
    code = F.when(direction == RISING, 1).when(direction == FALLING, -1).otherwise(0)
    return (
        ewma_results.groupBy("indicator", "metric")
        .agg(
            F.max("period").alias("latest_period"),
            F.max_by("trend_direction", "period").alias("trend_direction"),
        )
        .withColumn("trend_code", code)
    )


def portfolio_shares(snapshots: DataFrame, by: Sequence[str] = ("snapshot_month",)) -> DataFrame:
    """Workable and paused cases as shares of the open ones."""
    return snapshots.groupBy(*by).agg(
        F.try_divide(F.sum("open_workable").cast("double"), F.sum("open_total")).alias("andel_arbeidbar"),
        F.try_divide(F.sum("open_paused").cast("double"), F.sum("open_total")).alias("andel_pauset"),
    )


def early_share(snapshots: DataFrame, cases: DataFrame) -> DataFrame:
    """Early-processed cases of each snapshot month as a share of the cases received in it.

    Both counts are added up per month over one union, so no join is needed and only
    per-task month totals are shuffled.
    """
    early = snapshots.select(
        F.last_day("snapshot_month").alias("snapshot_month"),
        F.col("tidligbehandling_count").alias("early"),
        F.lit(0).alias("received"),
    )
    intake = cases.where(F.col("start_date").isNotNull()).select(
        F.last_day("start_date").alias("snapshot_month"),
        F.lit(None).cast("int").alias("early"),
        F.lit(1).alias("received"),
    )
    months = early.unionByName(intake).groupBy("snapshot_month")
    return (
        months.agg(F.sum("early").alias("early"), F.sum("received").alias("received"))
        .where(F.col("early").isNotNull())
        .withColumn("andel_tidligbehandling", F.try_divide(F.col("early").cast("double"), F.col("received")))
    )


def year_end_measures(projection_results: DataFrame) -> DataFrame:
    """Estimate and bounds at the last forecast period of each indicator.

    Every projected indicator has a row; without forecast periods, as when December is
    known, its measures are NULL.
    """
    ahead = F.when(F.col("type") == "forecast", F.col("period"))
    return projection_results.groupBy("indikator").agg(
        F.max(ahead).alias("period"),
        *[
            F.max_by(name, ahead).alias(label)
            for name, label in (
                ("year_end_estimate", "prognose_aarslutt"),
                ("ci_lower", "prognose_ci_lower"),
                ("ci_upper", "prognose_ci_upper"),
            )
        ],
    )


def projection_rag(
    projection_results: DataFrame,
    targets: DataFrame,
    *,
    target_column: str = "terskel_amber",
    active_column: str | None = "aktiv",
    tolerance: float = AMBER_TOLERANCE,
) -> DataFrame:
    """Estimate against target: 3 reached, 2 within the tolerance, 1 below, NULL if either is missing.

    ``targets`` holds one row per indicator or several, of which the active one with the
    lowest target counts. Spark sizes the small side itself; no broadcast is forced.
    """
    active = targets.where(F.col(active_column)) if active_column else targets
    target = active.groupBy("indikator").agg(F.min(target_column).alias("target"))
    estimate, limit = F.col("prognose_aarslutt"), F.col("target")
    status = (
        F.when(estimate.isNull() | limit.isNull(), None)
        .when(estimate >= limit, 3)
        .when(estimate >= limit * tolerance, 2)
        .otherwise(1)
    )
    return (
        year_end_measures(projection_results)
        .join(target, "indikator", "left")
        .select("indikator", "prognose_aarslutt", "target", status.cast("int").alias("rag"))
    )
