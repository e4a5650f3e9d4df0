"""Catalog tables for the results, and for the inputs where they are kept clustered by case.

A write that fails leaves the old rows. A whole table is written to a folder of its own, and one
catalog statement then points the table there; formats with transactions of their own overwrite in
place. Replacing partitions is a single dynamic overwrite, so readers never see it half gone, a
rerun after a lost job is safe, and no session setting is touched.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casepulse.schemas import RESULTS, conform

# The tables that keep other periods when one is rewritten, and what divides them.
PARTITIONED_BY: dict[str, T.StructField] = {
    "portefolje_snapshot": T.StructField("snapshot_month", T.DateType(), False),
    "projection_results": T.StructField("year", T.IntegerType(), False),
}


COMMENTS: dict[str, str] = {
    "cusum_results": "Drift of each series; signal marks periods beyond the threshold, OPP up, NED down.",
    "changepoint_results": "Level shifts of each series, with the means on both sides.",
    "cohort_results": "Share of each intake month still open, week by week, against its history.",
    "ewma_results": "Monthly series smoothed at two speeds, with the direction of the slow one.",
    "portefolje_snapshot": "Open cases per indicator at each month end, by milestone state.",
    "projection_results": "On-time rate of the year so far (actual) and its expected course (forecast).",
}


def create_database(spark: SparkSession, database: str) -> None:
    """Create the database unless it is there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


#: Formats whose tables are folders of files, without transactions of their own.
FILES = ("parquet", "orc", "json", "csv", "avro")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    partition: T.StructField | None = None,
    comment: str = "",
    buckets: int | None = None,
    cluster_by: str = "case_id",
) -> None:
    """Declare a table unless it is there; the partition column, if any, comes last.

    With ``buckets`` its rows are dealt over so many buckets by ``cluster_by`` and sorted by it in
    each, so that joins and aggregates by that column need no shuffle.
    """
    fields = [field for field in schema.fields if partition is None or field.name != partition.name]
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in [*fields, *([partition] if partition else [])]
    )
    divided = f" PARTITIONED BY (`{partition.name}`)" if partition else ""
    clustered = f" CLUSTERED BY (`{cluster_by}`) SORTED BY (`{cluster_by}`) INTO {buckets} BUCKETS" if buckets else ""
    quoted = comment.replace("'", "''")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{divided}{clustered} COMMENT '{quoted}'")


def result_table(spark: SparkSession, name: str, *, table: str | None = None, fmt: str = "parquet") -> None:
    """Declare one of the result tables, under its own name or another."""
    create_table(
        spark,
        table or name,
        RESULTS[name],
        fmt=fmt,
        partition=PARTITIONED_BY.get(name),
        comment=COMMENTS[name],
    )


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark reads it from."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _columns_in(text: str) -> list[str]:
    """The names in a description such as [`a`, `b`]."""
    return re.findall("`([^`]+)`", text)


def _publish(rows: DataFrame, table: str) -> None:
    """Write the rows beside the table, in its layout, then point the table at them and delete what it held."""
    spark = rows.sparkSession
    about = _described(spark, table)
    held = about["Location"]
    unique = uuid.uuid4().hex
    folder = f"{re.sub('__[0-9a-f]{32}$', '', held.rstrip('/'))}__{unique}"
    writer = rows.write.format(about["Provider"].lower()).option("path", folder)
    if int(about.get("Num Buckets", "0")) > 0:
        writer = writer.bucketBy(int(about["Num Buckets"]), *_columns_in(about["Bucket Columns"]))
        if sorting := _columns_in(about.get("Sort Columns", "")):
            writer = writer.sortBy(*sorting)
    # Only a catalog table can be written in buckets, so the rows get a name for as long as that takes.
    database = f"{table.rpartition('.')[0]}." if "." in table else ""
    staged = f"{database}staged_{unique}"
    try:
        writer.saveAsTable(staged)
        spark.sql(f"DROP TABLE {staged}")  # an external table: its files stay
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        remove_folder(spark, folder)
        raise
    spark.catalog.refreshTable(table)
    remove_folder(spark, held)


def overwrite(df: DataFrame, table: str, schema: T.StructType, *, fmt: str = "parquet") -> None:
    """Replace a whole table, also by nothing: results that no longer hold must not stay.

    A table declared before keeps its declaration; otherwise it is declared first. If the write
    fails, the table keeps its old rows, and one not there before is empty. A partitioned table
    first takes the new partitions in one commit, then loses those without rows.
    """
    rows, spark = conform(df, schema), df.sparkSession
    create_table(spark, table, schema, fmt=fmt)
    rows = rows.select(*spark.table(table).columns)
    divided = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    if _described(spark, table)["Provider"].lower() not in FILES:
        rows.write.mode("overwrite").insertInto(table)
    elif not divided:
        _publish(rows, table)
    else:
        before = spark.table(table).select(*divided).distinct().collect()
        seen = Observation()
        counted = rows.observe(seen, F.collect_set(F.struct(*divided)).alias("partitions"))
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {{rows}}", rows=counted
        )
        for row in set(before) - set(seen.get["partitions"]):
            named = ", ".join(f"`{name}` = '{row[name]}'" for name in divided)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({named})")


def store_clustered(
    df: DataFrame, table: str, *, buckets: int, columns: Mapping[str, str], by: str = "case_id", fmt: str = "parquet"
) -> None:
    """Write a table of cases or milestones in buckets by case, under the column names of the stored tables.

    ``columns`` gives the stored name of each column, as the readers take them. Tables with equal
    numbers of buckets are joined and aggregated by case without a shuffle of either.
    """
    rows = df.select(*[F.col(ours).alias(theirs) for ours, theirs in columns.items()])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    create_table(df.sparkSession, table, schema, fmt=fmt, buckets=buckets, cluster_by=columns[by])
    overwrite(rows, table, schema, fmt=fmt)


def replace_partitions(
    df: DataFrame, table: str, schema: T.StructType, partition: T.StructField, values: Sequence[date | int]
) -> None:
    """Replace the rows of some partition values by ``df``, also by nothing, and leave all others.

    ``schema`` names the partition column. A row of ``df`` with a value that is not one of
    ``values`` fails the write before anything is replaced. All values are written in one pass.
    """
    spark = df.sparkSession
    named = F.col(partition.name)
    complaint = F.raise_error(F.concat(F.lit(f"row outside {partition.name}: "), named.cast("string")))
    # Tested in a column that is written: a bare filter would drop such rows unseen.
    kept = next(name for name in schema.names if name != partition.name)
    tested = F.when(named.isin(*values), F.col(kept)).otherwise(complaint.cast(schema[kept].dataType))
    rows = conform(df, schema).withColumn(kept, tested).select(*spark.table(table).columns)
    written = Observation()
    counted = rows.observe(written, F.collect_set(named).alias("values"))
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} WITH ('partitionOverwriteMode' = 'dynamic') "
        f"PARTITION (`{partition.name}`) SELECT * FROM {{rows}}",
        rows=counted,
    )
    for value in set(values) - set(written.get["values"]):  # a dynamic overwrite by nothing leaves what was there
        _empty_partition(rows, table, partition, value)


def _empty_partition(rows: DataFrame, table: str, partition: T.StructField, value: date | int) -> None:
    spark = rows.sparkSession
    literal = f"DATE '{value}'" if isinstance(value, date) else str(int(value))
    others = [name for name in spark.table(table).columns if name != partition.name]
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (`{partition.name}` = {literal}) SELECT * FROM {{rows}}",
        rows=rows.select(*others).where("false"),
    )


def replace_partition(
    df: DataFrame, table: str, schema: T.StructType, partition: T.StructField, value: date | int
) -> None:
    """Replace the rows of one partition value by ``df``, also by nothing, and leave all others.

    A row of ``df`` that names another value fails the write before anything is replaced. Where
    ``schema`` does not name the partition column, the rows are all of that value.
    """
    if partition.name not in schema.names:
        df = df.withColumn(partition.name, F.lit(value).cast(partition.dataType))
        schema = T.StructType([*schema.fields, partition])
    replace_partitions(df, table, schema, partition, [value])
