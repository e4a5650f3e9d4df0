"""The scheduled jobs: read, compute, write, report.

Each job takes DataFrames and an explicit run time, writes its result tables in the format
``fmt`` names and returns them as read back, so that reports and measures start from the small written result and
never from the lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casepulse.operators import (
    Vocabulary,
    cohort_baseline,
    cohort_matrix,
    cusum,
    drift_specs,
    ewma_trend,
    metric_series,
    portfolio_snapshot,
    portfolio_snapshots,
    project,
    shifts,
    snapshot_month_end,
    trend_specs,
    ytd_rate,
)
from casepulse.operators.series import EXCLUDE_AGREED, START_YEAR
from casepulse.schemas import INDICATOR_CONFIG, RESULTS, batch_id_of, stamp
from casepulse.sinks import create_database, overwrite, remove_folder, replace_partitions, result_table
from casepulse.sinks.tables import PARTITIONED_BY
from casepulse.sources import indicator_config, read_result


@contextmanager
def stored_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder in ``spark.checkpoint.dir`` and read back, removed in the end."""
    context = df.sparkSession.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = f"{folder}/stored-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.parquet(path)
    finally:
        remove_folder(df.sparkSession, path)


def _name(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def _store(df: DataFrame, name: str, run_at: datetime, database: str | None, fmt: str) -> DataFrame:
    spark, table = df.sparkSession, _name(name, database)
    result_table(spark, name, table=table, fmt=fmt)
    overwrite(stamp(df, batch_id_of(run_at), run_at), table, RESULTS[name])
    return read_result(spark, table)


def _replace(df: DataFrame, name: str, values: Sequence, run_at: datetime, database: str | None, fmt: str) -> DataFrame:
    spark, table = df.sparkSession, _name(name, database)
    result_table(spark, name, table=table, fmt=fmt)
    stamped, schema = stamp(df, batch_id_of(run_at), run_at), RESULTS[name]
    partition = PARTITIONED_BY[name]
    if partition.name not in schema.names:  # all rows are of one value
        stamped = stamped.withColumn(partition.name, F.lit(values[0]).cast(partition.dataType))
        schema = T.StructType([*schema.fields, partition])
    replace_partitions(stamped, table, schema, partition, values)
    return read_result(spark, table)


def drift_job(
    cases: DataFrame,
    run_at: datetime,
    *,
    start_year: int = START_YEAR,
    exclude_like: str | None = EXCLUDE_AGREED,
    penalty: str | float = "log_n_var",
    database: str | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Write ``cusum_results`` and ``changepoint_results``.

    Both come from the same series, which are stored for the time of the job, so the cases
    are scanned once.
    """
    with stored_once(metric_series(cases, drift_specs(exclude_like), start_year=start_year)) as series:
        return {
            "cusum_results": _store(cusum(series), "cusum_results", run_at, database, fmt),
            "changepoint_results": _store(
                shifts(series, penalty=penalty), "changepoint_results", run_at, database, fmt
            ),
        }


def trend_job(
    cases: DataFrame,
    run_at: datetime,
    *,
    start_year: int = START_YEAR,
    exclude_like: str | None = EXCLUDE_AGREED,
    database: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Write ``ewma_results`` in full: every value depends on all earlier ones."""
    series = metric_series(cases, trend_specs(exclude_like), start_year=start_year)
    return _store(ewma_trend(series), "ewma_results", run_at, database, fmt)


def cohort_job(
    cases: DataFrame,
    run_at: datetime,
    *,
    as_of: date | None = None,
    start_year: int = START_YEAR,
    exclude_like: str | None = None,
    database: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Write ``cohort_results`` in full: closing a case changes its whole cohort."""
    matrix = cohort_matrix(cases, as_of or run_at.date(), start_year=start_year, exclude_like=exclude_like)
    return _store(cohort_baseline(matrix), "cohort_results", run_at, database, fmt)


def portfolio_job(
    cases: DataFrame,
    milestones: DataFrame,
    run_at: datetime,
    *,
    snapshot_month: date | None = None,
    vocabulary: Vocabulary = Vocabulary(),
    exclude_like: str | None = EXCLUDE_AGREED,
    database: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Replace one month of ``portefolje_snapshot``, by default the last one completed."""
    day = snapshot_month or snapshot_month_end(run_at.date())
    rows = portfolio_snapshot(cases, milestones, day, vocabulary=vocabulary, exclude_like=exclude_like)
    return _replace(rows, "portefolje_snapshot", [day], run_at, database, fmt)


def portfolio_history_job(
    cases: DataFrame,
    milestones: DataFrame,
    run_at: datetime,
    snapshot_months: Sequence[date],
    *,
    vocabulary: Vocabulary = Vocabulary(),
    exclude_like: str | None = EXCLUDE_AGREED,
    database: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Rebuild many months of ``portefolje_snapshot`` in one pass and one write."""
    rows = portfolio_snapshots(cases, milestones, snapshot_months, vocabulary=vocabulary, exclude_like=exclude_like)
    return _replace(rows, "portefolje_snapshot", list(snapshot_months), run_at, database, fmt)


def projection_job(
    cases: DataFrame,
    run_at: datetime,
    *,
    current_year: int | None = None,
    start_year: int = START_YEAR,
    exclude_like: str | None = EXCLUDE_AGREED,
    database: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Replace the current year of ``projection_results``."""
    year = current_year or run_at.year
    rows = project(ytd_rate(cases, start_year=start_year, exclude_like=exclude_like), year)
    return _replace(rows, "projection_results", [year], run_at, database, fmt)


def config_job(
    spark: SparkSession, *, table: str = "IndikatorConfig", database: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Write the indicator targets, creating the database if one is named."""
    if database:
        create_database(spark, database)
    overwrite(indicator_config(spark), _name(table, database), INDICATOR_CONFIG, fmt=fmt)
    return spark.table(_name(table, database))
