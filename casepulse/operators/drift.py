"""Two-sided cumulative-sum drift detection, as window expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casepulse.functions import round4
from casepulse.schemas import SERIES_KEY

# Allowance, decision threshold and least history, in observations.
CUSUM_K = 0.5
CUSUM_H = 5.0
MIN_OBS = {"monthly": 24, "weekly": 52}
MIN_OBS_ANY = 8

UP, DOWN = "OPP", "NED"
SIGMA_FLOOR = 1e-12


def required_obs(min_obs: Mapping[str, int]) -> Column:
    """The least number of observations for the row's granularity."""
    need = F.lit(MIN_OBS_ANY)
    for granularity, count in min_obs.items():
        need = F.when(F.col("granularity") == granularity, F.lit(max(count, MIN_OBS_ANY))).otherwise(need)
    return need


def cusum(
    series: DataFrame,
    *,
    k: float = CUSUM_K,
    h: float = CUSUM_H,
    min_obs: Mapping[str, int] = MIN_OBS,
) -> DataFrame:
    """Standardise each whole series and accumulate its drift in both directions.

    The recurrence ``P = max(0, P_before + z - k)``, zero at the first observation, equals
    the running sum of ``z - k`` less its running minimum (Lindley's identity), so plain
    window frames give it. A series is partitioned by its key alone: it holds one row per
    calendar bucket. Constant and short series give no rows.
    """
    whole = Window.partitionBy(*SERIES_KEY)
    in_order = whole.orderBy("period")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    observed = (
        series.where(F.col("value").isNotNull())
        .select(
            *SERIES_KEY,
            "period",
            "value",
            F.row_number().over(in_order).alias("position"),
            F.count("value").over(whole).alias("n"),
            F.avg("value").over(whole).alias("mu"),
            F.stddev_pop("value").over(whole).alias("sigma"),
        )
        .where((F.col("n") >= required_obs(min_obs)) & (F.col("sigma") > SIGMA_FLOOR))
        .withColumn("z", (F.col("value") - F.col("mu")) / F.col("sigma"))
    )

    def climb(increment: Column) -> Column:
        return F.sum(F.when(F.col("position") > 1, increment).otherwise(0.0)).over(so_far)

    climbed = observed.withColumns(
        {"climb_up": climb(F.col("z") - k), "climb_down": climb(-F.col("z") - k)}
    )
    drift = climbed.withColumns(
        {
            "up": F.col("climb_up") - F.min("climb_up").over(so_far),
            "down": F.col("climb_down") - F.min("climb_down").over(so_far),
        }
    )
    rising, falling = F.col("up") > h, F.col("down") > h
    return drift.select(
        *SERIES_KEY,
        "period",
        "value",
        round4(F.col("up")).alias("cusum_pos"),
        round4(F.col("down")).alias("cusum_neg"),
        (rising | falling).alias("signal"),
        F.when(rising, UP).when(falling, DOWN).alias("signal_direction"),
    )
