"""Resolution of intake cohorts, week by week, against their own history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casepulse.functions import month_period, on_or_after_year, round4, scaled4, shift_months
from casepulse.operators.series import START_YEAR

# Weeks followed, least cohort size, months counted as recent, tail trimmed.
MAX_WEEKS = 26
MIN_COHORT_SIZE = 10
RECENT_MONTHS = 6
TRIM = 0.1
TRIM_FROM = 5


def case_facts(cases: DataFrame, *, start_year: int = START_YEAR) -> DataFrame:
    """Intake month, days to resolution and open flag of every case with an intake date."""
    start = F.col("start_date")
    return cases.where(on_or_after_year(start, start_year)).select(
        "case_id",
        "indicator",
        F.date_format(start, "yyyyMM").alias("cohort_label"),
        month_period(start).alias("cohort_period"),
        start.alias("intake_date"),
        "end_date",
        F.datediff("end_date", start).alias("days_to_resolution"),
        F.when(F.col("stop_date").isNull(), 1).otherwise(0).alias("is_open"),
    )


def cohort_matrix(
    cases: DataFrame,
    as_of: date,
    *,
    max_weeks: int = MAX_WEEKS,
    min_size: int = MIN_COHORT_SIZE,
    recent_months: int = RECENT_MONTHS,
    start_year: int = START_YEAR,
    exclude_like: str | None = None,
) -> DataFrame:
    """Share of each (indicator, intake month) cohort still open after 1, 2, ... weeks.

    Weeks count from the first of the intake month, so a case not yet received counts as
    open; a case ending exactly on the reference date is closed. Only weeks whose reference
    date is not after ``as_of`` appear. One aggregate does the work: each case adds to the
    counters of the weeks it is closed in, so the shuffle carries one row per cohort and
    task, whatever the number of cases, and no case is multiplied by weeks.
    """
    cohort_start = F.trunc("start_date", "month")
    named = F.col("indicator").isNotNull()
    if exclude_like:
        named = named & ~F.col("indicator").like(exclude_like)

    weeks = range(1, max_weeks + 1)
    closed_by = {
        week: F.count_if(F.col("end_date") <= F.date_add("cohort_start", 7 * week)) for week in weeks
    }
    cohorts = (
        cases.where(named & on_or_after_year(F.col("start_date"), start_year))
        .select("indicator", "end_date", cohort_start.alias("cohort_start"))
        .groupBy("indicator", "cohort_start")
        .agg(F.count("*").alias("size"), *[count.alias(f"closed_{week}") for week, count in closed_by.items()])
        .where(F.col("size") >= min_size)
    )
    cells = cohorts.select(
        "indicator",
        "cohort_start",
        "size",
        F.posexplode(F.array(*[F.col(f"closed_{week}") for week in weeks])).alias("pos", "closed"),
    ).where(F.date_add("cohort_start", 7 * (F.col("pos") + 1)) <= F.lit(as_of))

    open_count = F.col("size") - F.col("closed")
    return cells.select(
        "indicator",
        month_period(F.col("cohort_start")).alias("cohort_period"),
        F.col("size").cast("int").alias("cohort_size"),
        (F.col("pos") + 1).cast("int").alias("weeks_since_intake"),
        open_count.cast("int").alias("open_count"),
        round4(open_count / F.col("size")).alias("pct_open"),
        (F.col("cohort_start") >= F.lit(shift_months(as_of, -recent_months))).alias("is_recent_cohort"),
    )


def cohort_baseline(matrix: DataFrame, *, trim: float = TRIM) -> DataFrame:
    """Add the trimmed historical mean at the same week, and the distance to it.

    History is the cohorts that are not recent. From five of them on, the shares ranked in
    ``[int(n * trim), int(n * (1 - trim)))`` are averaged, below that all. Everything is a
    window over (indicator, week), which holds one row per intake month, so the matrix is
    computed and shuffled once. Shares are summed as whole ten-thousandths, so the result
    does not depend on the order of rows.
    """
    cell = Window.partitionBy("indicator", "weeks_since_intake")
    ranked = cell.orderBy("is_recent_cohort", "pct_open", "cohort_period")
    past = ~F.col("is_recent_cohort")
    n, rank = F.col("n_past"), F.col("rank")
    first = F.greatest(F.lit(0), F.floor(n * F.lit(float(trim))))
    last = F.greatest(F.lit(1), F.floor(n * F.lit(1.0 - float(trim))))
    kept = past & ((n < TRIM_FROM) | ((rank > first) & (rank <= last)))
    points = scaled4(F.col("pct_open"))

    summed = matrix.withColumns(
        {"rank": F.row_number().over(ranked), "n_past": F.count_if(past).over(cell)}
    ).withColumns(
        {
            "kept_sum": F.sum(F.when(kept, points)).over(cell),
            "kept_n": F.count_if(kept).over(cell),
        }
    )
    baseline = F.col("kept_sum") / F.when(F.col("kept_n") > 0, F.col("kept_n")) / F.lit(1e4)
    return summed.withColumn("pct_open_historical", baseline).select(
        "indicator",
        "cohort_period",
        "cohort_size",
        "weeks_since_intake",
        "open_count",
        "pct_open",
        "pct_open_historical",
        round4(F.col("pct_open") - F.col("pct_open_historical")).alias("delta_historical"),
        "is_recent_cohort",
    )
