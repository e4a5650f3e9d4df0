"""Metric time series: one value per indicator and calendar bucket.

All requested series come from one scan. Rows are first aggregated to the coarsest cells
that nest in every requested bucket (month, week, or their intersection when both are
wanted), with map-side combine, so a hot indicator reaches the shuffle as at most one row
per cell and task. The cells, whose number is bounded by indicators x calendar, are then
rolled up to each series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casepulse.functions import month_period, on_or_after_year, week_period
from casepulse.schemas import SERIES_KEY

START_YEAR = 2015
EXCLUDE_AGREED = "%avtalt%"


@dataclass(frozen=True)
class SeriesSpec:
    """One series per indicator: what is measured, in which buckets, and for whom.

    ``frist_pct``  share of the cases with a deadline, closed in the bucket, that met it
    ``tidsbruk``   mean duration of the cases closed in the bucket
    ``prod_diff``  started minus closed cases, bucketed by the stop date, else the start date
    ``exclude_like`` drops indicators matching the (case-sensitive) LIKE pattern.
    """

    metric: str
    granularity: str = "monthly"
    exclude_like: str | None = None

    def __post_init__(self):
        if self.metric not in ("frist_pct", "tidsbruk", "prod_diff"):
            raise ValueError(f"unknown metric {self.metric!r}")
        if self.granularity not in ("monthly", "weekly"):
            raise ValueError(f"unknown granularity {self.granularity!r}")

    def admits(self) -> Column:
        """The indicator test of this series; a NULL indicator never passes."""
        named = F.col("indicator").isNotNull()
        return named & ~F.col("indicator").like(self.exclude_like) if self.exclude_like else named


def drift_specs(exclude_like: str | None = EXCLUDE_AGREED) -> list[SeriesSpec]:
    """The five series watched for drift; monthly rates and durations keep agreed indicators."""
    return [
        SeriesSpec("frist_pct", "monthly"),
        SeriesSpec("tidsbruk", "monthly"),
        SeriesSpec("prod_diff", "monthly", exclude_like),
        SeriesSpec("frist_pct", "weekly", exclude_like),
        SeriesSpec("prod_diff", "weekly", exclude_like),
    ]


def trend_specs(exclude_like: str | None = EXCLUDE_AGREED) -> list[SeriesSpec]:
    """The three monthly series that are smoothed."""
    return [SeriesSpec(metric, "monthly", exclude_like) for metric in ("frist_pct", "tidsbruk", "prod_diff")]


def _row_test(metric: str, start_year: int) -> Column:
    closed = on_or_after_year(F.col("stop_date"), start_year)
    if metric == "frist_pct":
        return closed & F.col("deadline").isNotNull()
    if metric == "tidsbruk":
        return closed & F.col("duration").isNotNull()
    still_open = F.col("stop_date").isNull() & on_or_after_year(F.col("start_date"), start_year)
    return closed | still_open


def metric_series(
    cases: DataFrame,
    specs: Sequence[SeriesSpec],
    *,
    start_year: int = START_YEAR,
    week_style: str = "calendar",
) -> DataFrame:
    """The requested series as (indicator, metric, granularity, period, value).

    Buckets without a case are absent, not zero.
    """
    tests = {spec.metric: _row_test(spec.metric, start_year) for spec in specs}
    day = F.coalesce("stop_date", "start_date") if "prod_diff" in tests else F.col("stop_date")
    bucket = {"monthly": month_period(day), "weekly": week_period(day, week_style)}
    grains = sorted({spec.granularity for spec in specs})

    # Each measure is (numerator, denominator, number of cases behind it).
    with_deadline = F.count_if(tests["frist_pct"]) if "frist_pct" in tests else None
    timed = F.count_if(tests["tidsbruk"]) if "tidsbruk" in tests else None
    measures = {
        "frist_pct": lambda: (F.count_if(tests["frist_pct"] & (F.col("on_time") == 1)), with_deadline),
        "tidsbruk": lambda: (
            F.sum(F.when(tests["tidsbruk"], F.col("duration").cast("double"))),
            timed,
        ),
        "prod_diff": lambda: (
            F.count_if(tests["prod_diff"] & F.col("start_date").isNotNull())
            - F.count_if(tests["prod_diff"] & F.col("stop_date").isNotNull()),
            F.count_if(tests["prod_diff"]),
        ),
    }
    columns = []
    for metric in tests:
        amount, size = measures[metric]()
        columns += [amount.cast("double").alias(f"{metric}_amount"), size.alias(f"{metric}_size")]

    wanted = reduce(lambda a, b: a | b, [spec.admits() & tests[spec.metric] for spec in specs])
    cells = (
        cases.where(wanted)
        .groupBy("indicator", *[bucket[grain].alias(grain) for grain in grains])
        .agg(*columns)
    )

    parts = F.array(
        *[
            F.struct(
                F.lit(spec.metric).alias("metric"),
                F.lit(spec.granularity).alias("granularity"),
                F.col(spec.granularity).alias("period"),
                F.col(f"{spec.metric}_amount").alias("amount"),
                F.when(spec.admits(), F.col(f"{spec.metric}_size")).otherwise(0).alias("size"),
            )
            for spec in specs
        ]
    )
    pieces = cells.select("indicator", F.inline(parts)).where("size > 0")
    if len(grains) > 1:
        pieces = pieces.groupBy(*SERIES_KEY, "period").agg(
            F.sum("amount").alias("amount"), F.sum("size").alias("size")
        )
    mean = F.col("amount") / F.col("size")
    value = F.when(F.col("metric") == "prod_diff", F.col("amount")).otherwise(mean)
    return pieces.select(*SERIES_KEY, "period", value.alias("value"))
