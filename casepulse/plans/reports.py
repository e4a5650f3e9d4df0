"""The reports drawn from the result tables. Ordered ones break ties by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casepulse.operators.trend import FALLING, RISING, STABLE
from casepulse.schemas import SERIES_KEY


def active_signals(cusum_results: DataFrame) -> DataFrame:
    """Series with a drift signal: the last period that gave one, and the greatest direction label."""
    return (
        cusum_results.where("signal")
        .groupBy(*SERIES_KEY)
        .agg(F.max("period").alias("last_signal_period"), F.max("signal_direction").alias("direction"))
        .orderBy("metric", "indicator", "granularity")
    )


def signal_count(cusum_results: DataFrame) -> DataFrame:
    """Number of result rows, and of rows with an active signal."""
    return cusum_results.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("signal")).alias("n_signals")
    )


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    return ordered if limit is None else ordered.limit(limit)


def largest_shifts(changepoint_results: DataFrame, limit: int | None = None) -> DataFrame:
    """The shifts with the greatest magnitude first; all unless a ``limit`` is asked for."""
    ordered = changepoint_results.orderBy(F.abs("shift_magnitude").desc(), *SERIES_KEY, "changepoint_period")
    return (
        _first(ordered, limit)
        .select(
            *SERIES_KEY,
            "changepoint_period",
            F.round("mean_before", 3).alias("before"),
            F.round("mean_after", 3).alias("after"),
            F.round("shift_magnitude", 3).alias("change"),
            "shift_direction",
        )
    )


def recent_cohorts(cohort_results: DataFrame, week: int = 12, limit: int | None = None) -> DataFrame:
    """Recent cohorts against their baseline at one week, in percent, slowest first; all unless a ``limit`` is asked for."""
    known = F.col("pct_open_historical").isNotNull()
    ordered = cohort_results.where((F.col("weeks_since_intake") == week) & F.col("is_recent_cohort") & known).orderBy(
        F.col("delta_historical").desc(), "indicator", "cohort_period"
    )
    return (
        _first(ordered, limit)
        .select(
            "indicator",
            "cohort_period",
            "cohort_size",
            *[
                F.round(F.col(name) * 100, 1).alias(label)
                for name, label in (
                    ("pct_open", "pct_open"),
                    ("pct_open_historical", "pct_open_historical"),
                    ("delta_historical", "delta_pct"),
                )
            ],
        )
    )


def at_latest_period(results: DataFrame) -> DataFrame:
    """The rows of the newest period. The maximum is a scalar subquery over the same input."""
    return results.where(F.col("period") == results.agg(F.max("period")).scalar())


def trend_crosstab(ewma_results: DataFrame) -> DataFrame:
    """Indicators per metric and direction at the newest period, zero-filled.

    Rows are counted per period and metric first; the newest period is then picked from
    one row per metric, so the frame over all of them is bounded by the three metrics.
    """
    labels = (RISING, FALLING, STABLE)
    counted = ewma_results.groupBy("metric", "period").agg(
        *[F.count_if(F.col("trend_direction") == label).alias(label) for label in labels]
    )
    newest = counted.groupBy("metric").agg(
        F.max("period").alias("period"), *[F.max_by(label, "period").alias(label) for label in labels]
    )
    overall = F.max("period").over(Window.partitionBy())
    return newest.withColumn("overall", overall).where("period = overall").drop("overall")


def active_trends(ewma_results: DataFrame, metric: str = "frist_pct") -> DataFrame:
    """Indicators that rise or fall at the newest period of all metrics."""
    moving = (F.col("metric") == metric) & (F.col("trend_direction") != STABLE)
    return (
        at_latest_period(ewma_results)
        .where(moving)
        .select(
            "indicator",
            "metric",
            F.round("value_raw", 3).alias("value"),
            F.round("ewma_slow", 3).alias("ewma_slow"),
            F.round("ewma_fast", 3).alias("ewma_fast"),
            "trend_direction",
        )
        .orderBy("trend_direction", "indicator")
    )


def projection_summary(
    projection_results: DataFrame, current_year: int, limit: int | None = None
) -> DataFrame:
    """Highest rate so far, year-end estimate and December bounds, most at risk first; all unless a ``limit`` is asked for."""
    actual = F.col("type") == "actual"
    december = (F.col("type") == "forecast") & (F.col("period") == current_year * 100 + 12)

    def when_max(test: Column, name: str) -> Column:
        return F.max(F.when(test, F.col(name)))

    ordered = (
        projection_results.groupBy("indikator")
        .agg(
            when_max(actual, "verdi").alias("ytd_naa"),
            F.max("year_end_estimate").alias("prognose_aarslutt"),
            when_max(december, "ci_lower").alias("ci_lower"),
            when_max(december, "ci_upper").alias("ci_upper"),
        )
        .orderBy("prognose_aarslutt", "indikator")
    )
    return _first(ordered, limit)


def snapshot_audit(snapshots: DataFrame, batch_id: str) -> DataFrame:
    """Rows written per snapshot month by one batch."""
    return (
        snapshots.where(F.col("batch_id") == batch_id)
        .groupBy("snapshot_month")
        .agg(F.count("*").alias("rader"))
    )
