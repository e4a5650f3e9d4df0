"""Structural changepoints of a series, and the shift in level at each.

The search is a penalised kernel segmentation (Arlot, Celisse and Harchaoui; Killick,
Fearnhead and Eckley for the recursion and its pruning). Its dynamic programme has no SQL form, so it is
the one place where rows pass through Python: once per series, in Arrow batches, on rows
already aggregated to calendar buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casepulse.functions import round4
from casepulse.operators.drift import DOWN, MIN_OBS, UP, required_obs
from casepulse.schemas import SERIES_KEY

MIN_SIZE = 6
MIN_SIDE = 3


def kernel_splitter(min_size: int = MIN_SIZE, penalty: str | float = "log_n_var"):
    """A function from a vector to its optimal segment starts, the leading 0 left out.

    Everything it needs is nested here, so it travels to executors by value. Its ``work`` adds up
    the kernel values computed.
    """
    if not (penalty in ("log_n_var", "log_n") or isinstance(penalty, (int, float))):
        raise ValueError(f"unknown penalty {penalty!r}")

    import numpy as np

    def median_squared_gap(x):
        """Exact median of (a - b)^2 over all pairs, in linear memory.

        The k-th smallest gap of the sorted values is bisected on the number of pairs
        within a distance.
        """
        ordered = np.sort(x)
        n = len(ordered)
        pairs = n * (n - 1) // 2
        own = np.arange(1, n + 1)

        def within(gap):
            return int((np.searchsorted(ordered, ordered + gap, side="right") - own).sum())

        def kth(k):
            if within(0.0) >= k:
                return 0.0
            low, high = 0.0, float(ordered[-1] - ordered[0])
            while low < (middle := (low + high) / 2) < high:
                low, high = (low, middle) if within(middle) >= k else (middle, high)
            return high

        lower, upper = kth((pairs + 1) // 2), kth(pairs // 2 + 1)
        return (lower**2 + upper**2) / 2

    def split(x):
        x = np.asarray(x, dtype=float)
        n = len(x)
        if n < 2 * min_size:
            return []
        median = median_squared_gap(x)
        gamma = 1.0 / median if median > 0 else 1.0
        beta = {"log_n_var": np.log(n) * np.var(x), "log_n": np.log(n)}.get(penalty, penalty)
        if beta > n:  # a segment never costs more than its points, so no break can pay
            return []

        within = np.zeros(n)  # kernel sum of the segment from s up to the newest point
        best = np.full(n + 1, np.inf)
        best[0] = 0.0
        origin = np.zeros(n + 1, dtype=int)
        useless = np.full(n + 1, n + 1)  # the first end for which a start need not be looked at
        oldest = 0
        for t in range(1, n + 1):
            while oldest < t - 1 and useless[oldest] <= t:
                oldest += 1
            newest = x[t - 1]
            similar = np.exp(-gamma * (x[oldest : t - 1] - newest) ** 2)
            within[oldest : t - 1] += 2.0 * np.cumsum(similar[::-1])[::-1]
            within[oldest:t] += 1.0
            work[0] += t - oldest
            if t < min_size:
                continue
            starts = np.arange(oldest, t - min_size + 1)
            length = t - starts
            spent = best[starts] + (length - within[starts] / length)
            total = np.where(useless[starts] > t, spent + beta, np.inf)
            origin[t] = starts[np.argmin(total)]
            best[t] = total.min()
            # Splitting a segment never adds to its cost. So where even without a further break a
            # start has spent more than the best way to t, going on from t is cheaper for every
            # end that leaves room for a segment after t.
            worse = starts[spent > best[t] + 1e-9 * (1.0 + abs(best[t]))]
            useless[worse] = np.minimum(useless[worse], t + min_size)

        found = []
        while (n := int(origin[n])) > 0:
            found.append(n)
        return found[::-1]

    work = [0]
    split.work = work
    return split


def segment_series(
    series: DataFrame,
    *,
    min_size: int = MIN_SIZE,
    penalty: str | float = "log_n_var",
    min_obs: Mapping[str, int] = MIN_OBS,
) -> DataFrame:
    """Every observation of the series that break, with its position and segment number.

    ``penalty`` is the price of a breakpoint: ``log_n_var`` for ln(n) times the variance,
    ``log_n`` for ln(n) (the cost itself has no unit, so this one does not depend on the
    scale of the values), or a number. Series without a break give no rows. Memory is linear in
    the length of a series, itself one row per bucket. Starts that cannot be best again are
    dropped, so work grows with the length times the distance of breaks, and with the square
    only of stretches without any.
    """
    split = kernel_splitter(min_size, penalty)

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("period", ignore_index=True)
        breaks = split(rows["value"].to_numpy())
        if not breaks:
            return rows.iloc[:0].assign(position=0, segment=0)
        started = rows.index.isin(breaks)
        return rows.assign(position=rows.index.astype("int32"), segment=started.cumsum().astype("int32"))

    enough = (
        series.where(F.col("value").isNotNull())
        .withColumn("n", F.count("value").over(Window.partitionBy(*SERIES_KEY)))
        .where(F.col("n") >= required_obs(min_obs))
        .select(*SERIES_KEY, "period", "value")
    )
    return enough.groupBy(*SERIES_KEY).applyInPandas(
        cut,
        "indicator string, metric string, granularity string, "
        "period int, value double, position int, segment int",
    )


def mark_segments(series: DataFrame, breakpoints: DataFrame | Sequence[int]) -> DataFrame:
    """Number the segments of each series cut at given positions (0-based, non-NULL values).

    ``breakpoints`` is a list of positions for all series, or a DataFrame with the series
    key and ``bp``.
    """
    in_order = Window.partitionBy(*SERIES_KEY).orderBy("period")
    numbered = series.where(F.col("value").isNotNull()).withColumn(
        "position", F.row_number().over(in_order) - 1
    )
    if isinstance(breakpoints, DataFrame):
        cuts = breakpoints.select(*SERIES_KEY, F.col("bp").cast("int").alias("position"))
        cuts = cuts.distinct().withColumn("cut", F.lit(1))
        marked = numbered.join(cuts, [*SERIES_KEY, "position"], "left")
        is_cut = F.col("cut").isNotNull() & (F.col("position") > 0)
    else:
        marked = numbered
        is_cut = F.col("position").isin([int(p) for p in breakpoints if p > 0])
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("segment", F.sum(is_cut.cast("int")).over(so_far)).select(
        *SERIES_KEY, "period", "value", "position", "segment"
    )


def changepoints(series: DataFrame, **options) -> DataFrame:
    """Breakpoints as (series key, bp, period); options as in :func:`segment_series`."""
    return (
        segment_series(series, **options)
        .where("segment > 0")
        .groupBy(*SERIES_KEY, "segment")
        .agg(F.min("position").alias("bp"), F.min("period").alias("period"))
        .select(*SERIES_KEY, "bp", "period")
    )


def _shift_rows(segmented: DataFrame, min_side: int) -> DataFrame:
    segments = segmented.groupBy(*SERIES_KEY, "segment").agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.min("period").alias("first_period")
    )
    in_order = Window.partitionBy(*SERIES_KEY).orderBy("segment")
    onwards = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sides = segments.select(
        *SERIES_KEY,
        F.col("first_period").alias("changepoint_period"),
        (F.lag("total").over(in_order) / F.lag("n").over(in_order)).alias("mean_before"),
        (F.sum("total").over(onwards) / F.sum("n").over(onwards)).alias("mean_after"),
        F.lag("n").over(in_order).cast("int").alias("n_obs_before"),
        F.sum("n").over(onwards).cast("int").alias("n_obs_after"),
    ).where((F.col("n_obs_before") >= min_side) & (F.col("n_obs_after") >= min_side))
    shift = F.col("mean_after") - F.col("mean_before")
    return sides.select(
        *SERIES_KEY,
        "changepoint_period",
        round4(F.col("mean_before")).alias("mean_before"),
        round4(F.col("mean_after")).alias("mean_after"),
        round4(shift).alias("shift_magnitude"),
        F.when(shift > 0, UP).otherwise(DOWN).alias("shift_direction"),
        "n_obs_before",
        "n_obs_after",
    )


def shift_stats(
    series: DataFrame, breakpoints: DataFrame | Sequence[int], *, min_side: int = MIN_SIDE
) -> DataFrame:
    """Level before and after each breakpoint.

    Before is the stretch since the previous breakpoint; after runs to the end of the
    series. A breakpoint with fewer than ``min_side`` values on either side is left out but
    still bounds the next one.
    """
    return _shift_rows(mark_segments(series, breakpoints), min_side)


def shifts(series: DataFrame, *, min_side: int = MIN_SIDE, **options) -> DataFrame:
    """The rows of ``changepoint_results``: search and shift statistics in one pass."""
    return _shift_rows(segment_series(series, **options), min_side)
