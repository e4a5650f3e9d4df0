"""Column contracts of the inputs and of the result tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casepulse.functions import round4

#: The identity of one time series.
SERIES_KEY = ("indicator", "metric", "granularity")


REQUIRED, OPTIONAL = False, True
_KINDS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(*columns: tuple[str, str, bool]) -> T.StructType:
    """A schema from name, type and whether NULL is allowed."""
    return T.StructType([T.StructField(name, _KINDS[kind], null) for name, kind, null in columns])


CASES = _schema(
    ("case_id", "bigint", REQUIRED),
    ("indicator", "string", OPTIONAL),
    ("start_date", "date", OPTIONAL),
    ("stop_date", "date", OPTIONAL),
    ("end_date", "date", OPTIONAL),
    ("deadline", "date", OPTIONAL),
    ("agg_deadline", "date", OPTIONAL),
    ("on_time", "int", OPTIONAL),
    ("duration", "double", OPTIONAL),
)
MILESTONES = _schema(
    ("case_id", "bigint", REQUIRED),
    ("milestone", "string", OPTIONAL),
    ("milestone_ts", "timestamp", OPTIONAL),
)
SERIES = _schema(
    ("indicator", "string", REQUIRED),
    ("metric", "string", REQUIRED),
    ("granularity", "string", REQUIRED),
    ("period", "int", REQUIRED),
    ("value", "double", OPTIONAL),
)
INDICATOR_CONFIG = _schema(
    ("indikator", "string", REQUIRED),
    ("target", "int", REQUIRED),
    ("target_red", "double", REQUIRED),
    ("target_amber", "double", REQUIRED),
)
ALERT_CONFIG = _schema(
    ("indikator", "string", OPTIONAL),
    ("terskel_amber", "double", OPTIONAL),
    ("aktiv", "boolean", OPTIONAL),
)

# Names, order and types of the result tables are the contract with their readers.
RESULTS: dict[str, T.StructType] = {
    "cusum_results": _schema(
        ("indicator", "string", REQUIRED),
        ("metric", "string", REQUIRED),
        ("granularity", "string", REQUIRED),
        ("period", "int", REQUIRED),
        ("value", "double", OPTIONAL),
        ("cusum_pos", "double", OPTIONAL),
        ("cusum_neg", "double", OPTIONAL),
        ("signal", "boolean", REQUIRED),
        ("signal_direction", "string", OPTIONAL),
        ("computed_at", "timestamp", REQUIRED),
        ("batch_id", "string", REQUIRED),
    ),
    "changepoint_results": _schema(
        ("indicator", "string", REQUIRED),
        ("metric", "string", REQUIRED),
        ("granularity", "string", REQUIRED),
        ("changepoint_period", "int", REQUIRED),
        ("mean_before", "double", OPTIONAL),
        ("mean_after", "double", OPTIONAL),
        ("shift_magnitude", "double", OPTIONAL),
        ("shift_direction", "string", OPTIONAL),
        ("n_obs_before", "int", OPTIONAL),
        ("n_obs_after", "int", OPTIONAL),
        ("computed_at", "timestamp", REQUIRED),
        ("batch_id", "string", REQUIRED),
    ),
    "cohort_results": _schema(
        ("indicator", "string", REQUIRED),
        ("cohort_period", "int", REQUIRED),
        ("cohort_size", "int", REQUIRED),
        ("weeks_since_intake", "int", REQUIRED),
        ("open_count", "int", REQUIRED),
        ("pct_open", "double", REQUIRED),
        ("pct_open_historical", "double", OPTIONAL),
        ("delta_historical", "double", OPTIONAL),
        ("is_recent_cohort", "boolean", REQUIRED),
        ("computed_at", "timestamp", REQUIRED),
        ("batch_id", "string", REQUIRED),
    ),
    "ewma_results": _schema(
        ("indicator", "string", REQUIRED),
        ("metric", "string", REQUIRED),
        ("period", "int", REQUIRED),
        ("value_raw", "double", OPTIONAL),
        ("ewma_slow", "double", OPTIONAL),
        ("ewma_fast", "double", OPTIONAL),
        ("ewma_slope_slow", "double", OPTIONAL),
        ("ewma_slope_fast", "double", OPTIONAL),
        ("trend_direction", "string", OPTIONAL),
        ("computed_at", "timestamp", REQUIRED),
        ("batch_id", "string", REQUIRED),
    ),
    "portefolje_snapshot": _schema(
        ("snapshot_month", "date", REQUIRED),
        ("indikator", "string", REQUIRED),
        ("open_total", "int", REQUIRED),
        ("open_workable", "int", REQUIRED),
        ("open_paused", "int", REQUIRED),
        ("open_mini_hearing", "int", REQUIRED),
        ("tidligbehandling_count", "int", REQUIRED),
        ("computed_at", "timestamp", REQUIRED),
        ("batch_id", "string", REQUIRED),
    ),
    "projection_results": _schema(
        ("indikator", "string", REQUIRED),
        ("period", "int", REQUIRED),
        ("type", "string", REQUIRED),
        ("verdi", "double", OPTIONAL),
        ("ci_lower", "double", OPTIONAL),
        ("ci_upper", "double", OPTIONAL),
        ("year_end_estimate", "double", OPTIONAL),
        ("computed_at", "timestamp", REQUIRED),
        ("batch_id", "string", REQUIRED),
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; a NULL in a NOT NULL column fails the job.

    The test is part of the projection, so it costs no pass of its own.
    """

    def column(field: T.StructField):
        value = F.col(field.name).cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        complaint = F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}"))
        return F.coalesce(value, complaint.cast(field.dataType)).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def stamp(df: DataFrame, batch_id: str, computed_at: datetime) -> DataFrame:
    """Add the two run columns every result table ends with."""
    return df.withColumns(
        {
            "computed_at": F.lit(computed_at).cast("timestamp"),
            "batch_id": F.lit(batch_id),
        }
    )


def batch_id_of(computed_at: datetime) -> str:
    """The run identifier that belongs to a run time."""
    return computed_at.strftime("%Y%m%dT%H%M%S")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round the named columns to four decimals, keeping their place."""
    return df.withColumns({name: round4(F.col(name)) for name in columns})
