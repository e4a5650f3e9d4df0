"""Exponential smoothing at two speeds, and the direction of the slow one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casepulse.functions import round4
from casepulse.schemas import SERIES_KEY

# Smoothing factors and, per metric, the slope that counts as a trend.
EWMA_ALPHAS = {"slow": 0.1, "fast": 0.3}
TREND_THRESHOLDS = {"frist_pct": 0.002, "tidsbruk": 0.5, "prod_diff": 5.0}
DEFAULT_THRESHOLD = 0.002

#: Rows that the fold of a series adds to before it begins a new array.
STRETCH = 128

RISING, FALLING, STABLE = "Stigende", "Synkende", "Stabil"


def ewma(series: DataFrame, *, alphas: Mapping[str, float] = EWMA_ALPHAS, min_rows: int = 3) -> DataFrame:
    """Smooth every series: the first value, then ``a * x + (1 - a) * previous``.

    Adds ``ewma_<speed>`` and ``ewma_slope_<speed>`` per entry of ``alphas``, unrounded.
    Steps follow the rows, so a missing month is not a decay step. Series with fewer than
    ``min_rows`` values are dropped. The recursion folds an array holding one series, stretch by
    stretch, so that adding a row copies a stretch at most and never the series so far.
    """
    level = {speed: f"ewma_{speed}" for speed in alphas}
    fields = ", ".join(["period: int", "value: double", *[f"{name}: double" for name in level.values()]])
    row = f"array<struct<{fields}>>"

    def step(done: Column, point: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        smoothed = [
            F.coalesce(
                F.lit(alpha) * point["value"] + F.lit(1 - alpha) * last[level[speed]], point["value"]
            ).alias(level[speed])
            for speed, alpha in alphas.items()
        ]
        here = F.struct(point["period"].alias("period"), point["value"].alias("value"), *smoothed)
        return F.concat(done, F.array(here))

    def stretch(done: Column, points: Column) -> Column:
        """The next points, folded from the last row of the stretch before; its rows stay where they are."""
        rows = F.aggregate(points, done["last"], step)
        fresh = F.slice(rows, F.size(done["last"]) + 1, F.lit(STRETCH))
        return F.struct(F.concat(done["rows"], F.array(fresh)).alias("rows"), F.slice(rows, F.lit(-1), F.lit(1)).alias("last"))

    points = F.sort_array(F.collect_list(F.struct("period", "value")))
    begins = F.sequence(F.lit(1), F.size("points"), F.lit(STRETCH))
    stretches = F.transform(begins, lambda at: F.slice("points", at, F.lit(STRETCH)))
    nothing = F.struct(F.array().cast(f"array<{row}>").alias("rows"), F.array().cast(row).alias("last"))
    smoothed = (
        series.where(F.col("value").isNotNull())
        .groupBy(*SERIES_KEY)
        .agg(points.alias("points"))
        .where(F.size("points") >= F.lit(max(1, min_rows)))
        .select(*SERIES_KEY, F.inline(F.flatten(F.aggregate(stretches, nothing, stretch, lambda done: done["rows"]))))
    )
    in_order = Window.partitionBy(*SERIES_KEY).orderBy("period")
    return smoothed.withColumns(
        {
            f"ewma_slope_{speed}": F.col(name) - F.lag(name).over(in_order)
            for speed, name in level.items()
        }
    )


def trend(smoothed: DataFrame, *, thresholds: Mapping[str, float] = TREND_THRESHOLDS) -> DataFrame:
    """Label each row by its slow slope against the threshold of its metric (strictly beyond it)."""
    limit = F.lit(DEFAULT_THRESHOLD)
    for metric, threshold in thresholds.items():
        limit = F.when(F.col("metric") == metric, F.lit(threshold)).otherwise(limit)
    slope = F.col("ewma_slope_slow")
    label = F.when(slope > limit, RISING).when(slope < -limit, FALLING).otherwise(STABLE)
    return smoothed.withColumn("trend_direction", label)


def ewma_trend(
    series: DataFrame,
    *,
    alphas: Mapping[str, float] = EWMA_ALPHAS,
    thresholds: Mapping[str, float] = TREND_THRESHOLDS,
    min_rows: int = 3,
) -> DataFrame:
    """The rows of ``ewma_results``: smoothed, labelled, rounded to four decimals."""
    labelled = trend(ewma(series, alphas=alphas, min_rows=min_rows), thresholds=thresholds)
    numbers = {"value": "value_raw"} | {
        name: name for speed in alphas for name in (f"ewma_{speed}", f"ewma_slope_{speed}")
    }
    order = ["value", *[f"ewma_{s}" for s in alphas], *[f"ewma_slope_{s}" for s in alphas]]
    return labelled.select(
        "indicator",
        "metric",
        "period",
        *[round4(F.col(name)).alias(numbers[name]) for name in order],
        "trend_direction",
    )
