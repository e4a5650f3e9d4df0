"""Case and milestone tables under whatever column names they carry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casepulse.schemas import RESULTS

# Column names of the lakehouse tables, by the name the operators use.
CASE_COLUMNS: dict[str, str] = {
    "case_id": "Prosess_id",
    "indicator": "Indikator",
    "start_date": "tidligste_startmilepael_dato",
    "stop_date": "seneste_stoppmilepael_dato",
    "end_date": "siste_stoppmilepael_dato",
    "deadline": "Frist",
    "agg_deadline": "aggregert_frist",
    "on_time": "innenfor_frist",
    "duration": "Tidsbruk",
}
MILESTONE_COLUMNS: dict[str, str] = {
    "case_id": "Prosess_id",
    "milestone": "Milepel",
    "milestone_ts": "Sluttdato",
}


def standardise(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project ``df`` onto the operators' names; unused columns never leave the scan."""
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def read_cases(
    spark: SparkSession, table: str = "Prosesser", columns: Mapping[str, str] = CASE_COLUMNS
) -> DataFrame:
    """The case table: one row per case process, with a unique case key."""
    return standardise(spark.table(table), columns)


def read_milestones(
    spark: SparkSession, table: str = "Milepeler", columns: Mapping[str, str] = MILESTONE_COLUMNS
) -> DataFrame:
    """The milestone log: any number of rows per case."""
    return standardise(spark.table(table), columns)


def read_result(spark: SparkSession, table: str, contract: str | None = None) -> DataFrame:
    """A result table, its columns back in contract order whatever it is partitioned by."""
    schema = RESULTS[contract or table.rsplit(".", 1)[-1]]
    return spark.table(table).select(*schema.fieldNames())
