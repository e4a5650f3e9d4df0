"""Year-end projection of the on-time rate from its seasonal course.

The year-to-date rows of an indicator are bounded by the calendar, so after the one large
aggregate everything is windows partitioned by the indicator. History and current year stay
in the same rows throughout: no self-join, and the cases are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casepulse.functions import on_or_after_year, round4
from casepulse.operators.series import EXCLUDE_AGREED, START_YEAR

# Least complete years, years trimmed at each end, width of the interval (80%).
MIN_YEARS = 3
TRIM_N = 1
Z = 1.28


def ytd_rate(
    cases: DataFrame, *, start_year: int = START_YEAR, exclude_like: str | None = EXCLUDE_AGREED
) -> DataFrame:
    """Cumulative on-time rate by month within each year, for months with data."""
    stop = F.col("stop_date")
    due = on_or_after_year(stop, start_year) & F.col("agg_deadline").isNotNull() & F.col("indicator").isNotNull()
    if exclude_like:
        due = due & ~F.col("indicator").like(exclude_like)
    monthly = (
        cases.where(due)
        .groupBy("indicator", F.year(stop).alias("year"), F.month(stop).alias("month"))
        .agg(F.count_if(F.col("on_time") == 1).alias("on_time"), F.count("*").alias("total"))
    )
    so_far = (
        Window.partitionBy("indicator", "year")
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = monthly.select(
        "indicator",
        "year",
        "month",
        F.sum("on_time").over(so_far).alias("cum_on_time"),
        F.sum("total").over(so_far).alias("cum_total"),
    )
    return sums.withColumn("ytd", F.col("cum_on_time") / F.col("cum_total"))


def _month_board(ytd: DataFrame, current_year: int, min_years: int, trim_n: int) -> DataFrame:
    """Per indicator and calendar month: trimmed ratio statistics and this year's rate."""
    of_indicator = Window.partitionBy("indicator")
    of_year = Window.partitionBy("indicator", "year")
    of_month = Window.partitionBy("indicator", "month")
    past, december = F.col("year") < current_year, F.col("month") == 12

    with_ends = (
        ytd.withColumn("complete_years", F.count_if(past & december).over(of_indicator))
        .where(F.col("complete_years") >= min_years)
        .withColumn("year_end", F.max(F.when(december, F.col("ytd"))).over(of_year))
        .withColumn("ratio", F.when(past, F.col("ytd") / F.nullif("year_end", F.lit(0.0))))
    )
    in_order = of_month.orderBy(F.col("ratio").asc_nulls_last(), "year")
    ranked = with_ends.withColumns(
        {"rank": F.row_number().over(in_order), "n": F.count("ratio").over(of_month)}
    )
    inner = (F.col("rank") > trim_n) & (F.col("rank") <= F.col("n") - trim_n)
    kept = F.col("ratio").isNotNull() & (F.col("n") >= min_years) & ((F.col("n") <= 2 * trim_n) | inner)
    ratio = F.when(kept, F.col("ratio"))
    return ranked.groupBy("indicator", "month").agg(
        F.avg(ratio).alias("mean_ratio"),
        F.stddev_pop(ratio).alias("std_ratio"),
        F.count(ratio).alias("n_years"),
        F.max(F.when(F.col("year") == current_year, F.col("ytd"))).alias("current_ytd"),
    )


def seasonal_profile(
    ytd: DataFrame, current_year: int, *, min_years: int = MIN_YEARS, trim_n: int = TRIM_N
) -> DataFrame:
    """Share of the year-end rate usually reached by each month.

    Complete years are past years with data in December; an indicator needs ``min_years`` of
    them, and a month as many ratios. The ``trim_n`` lowest and highest ratios are dropped
    while any remain; mean and population deviation are taken over the rest.
    """
    board = _month_board(ytd, current_year, min_years, trim_n)
    return board.where("n_years > 0").select(
        "indicator", "month", "mean_ratio", "std_ratio", F.col("n_years").cast("int").alias("n_years")
    )


def _year_end(rate: Column, mean: Column, std: Column, z: float) -> dict[str, Column]:
    """Estimate and bounds of the year-end rate; NULL where the ratio is missing or zero."""
    mean = F.nullif(mean, F.lit(0.0))
    estimate = rate / mean
    spread = F.lit(z) * (rate * std / (mean * mean))
    uncertain = std > 0
    lower = F.when(uncertain, F.greatest(F.lit(0.0), estimate - spread)).otherwise(estimate)
    upper = F.when(uncertain, F.least(F.lit(1.0), estimate + spread)).otherwise(estimate)
    return {
        name: round4(F.when(mean.isNotNull(), value))
        for name, value in (("estimate", estimate), ("lower", lower), ("upper", upper))
    }


def project(
    ytd: DataFrame,
    current_year: int,
    *,
    min_years: int = MIN_YEARS,
    trim_n: int = TRIM_N,
    z: float = Z,
) -> DataFrame:
    """The rows of ``projection_results``: this year's actual months, then forecast ones.

    A forecast scales the latest rate by the ratio of the two months' means; its bounds are
    those of the year-end estimate seen from that month.
    """
    of_indicator = Window.partitionBy("indicator")
    at_latest = F.col("month") == F.col("latest_month")
    board = (
        _month_board(ytd, current_year, min_years, trim_n)
        .withColumns(
            {
                "latest_month": F.max(F.when(F.col("current_ytd").isNotNull(), F.col("month"))).over(of_indicator),
                "profile_months": F.count("mean_ratio").over(of_indicator),
            }
        )
        .where("latest_month IS NOT NULL AND profile_months > 0")
        .withColumns(
            {
                f"latest_{name}": F.max(F.when(at_latest, F.col(column))).over(of_indicator)
                for name, column in (("ytd", "current_ytd"), ("mean", "mean_ratio"), ("std", "std_ratio"))
            }
        )
    )
    year_end = _year_end(F.col("latest_ytd"), F.col("latest_mean"), F.col("latest_std"), z)
    actual = F.col("current_ytd").isNotNull()
    ahead = (F.col("month") > F.col("latest_month")) & F.col("mean_ratio").isNotNull() & (F.col("latest_mean") != 0)
    forecast = F.col("latest_ytd") * (F.col("mean_ratio") / F.nullif("latest_mean", F.lit(0.0)))
    seen_ahead = _year_end(forecast, F.col("mean_ratio"), F.col("std_ratio"), z)
    return board.where(actual | ahead).select(
        F.col("indicator").alias("indikator"),
        (F.lit(current_year * 100) + F.col("month")).cast("int").alias("period"),
        F.when(actual, "actual").otherwise("forecast").alias("type"),
        round4(F.when(actual, F.col("current_ytd")).otherwise(forecast)).alias("verdi"),
        F.when(~actual, seen_ahead["lower"]).alias("ci_lower"),
        F.when(~actual, seen_ahead["upper"]).alias("ci_upper"),
        year_end["estimate"].alias("year_end_estimate"),
    )
