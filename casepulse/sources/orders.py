"""Orders and their line items read as case processes and milestones.

An order is a case of the indicator given by its priority; its line items are milestones,
and the first shipment on or after the order date closes it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casepulse.operators.portfolio import Vocabulary

# Days allowed per priority, and the meaning of return flag and line status.
DEADLINE_DAYS = {"1-URGENT": 21, "2-HIGH": 84, "3-MEDIUM": 126, "4-NOT SPECIFIED": 365}
ORDER_VOCABULARY = Vocabulary(
    paused=("AF", "AO"),
    resume=("RF", "NF"),
    workable=("NF", "RF", "RO"),
    mini_hearing="AO",
    early="NO",
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _days_allowed(priority: Column) -> Column:
    days = F.lit(None).cast("int")
    for name, allowed in DEADLINE_DAYS.items():
        days = F.when(priority == name, F.lit(allowed)).otherwise(days)
    return days


def order_cases(spark: SparkSession, folder: str, as_of: date | None = None) -> DataFrame:
    """All orders, or those placed by ``as_of`` as that day knows them.

    Line items are folded to their different ship dates per order before the join, hashed
    and with map-side combine, so an order with very many line items weighs no more than the
    number of days. Both tables are large, so the join is asked to merge rather than left to
    an estimate that might broadcast one.
    """
    ordered = F.col("o_orderdate").cast("date")
    shipped = F.col("l_shipdate").cast("date")
    orders, items = _table(spark, folder, "orders"), _table(spark, folder, "lineitem")
    if as_of is not None:
        orders, items = orders.where(ordered <= F.lit(as_of)), items.where(shipped <= F.lit(as_of))
    orders = orders.select(
        F.col("o_orderkey").alias("case_id"),
        F.col("o_orderpriority").alias("indicator"),
        ordered.alias("start_date"),
    )
    shipments = items.select(F.col("l_orderkey").alias("case_id"), shipped.alias("shipped")).distinct()
    in_time = shipments.shipped >= orders.start_date
    placed = [orders[name] for name in ("case_id", "indicator", "start_date")]
    first = (
        orders.join(shipments.hint("merge"), (orders.case_id == shipments.case_id) & in_time, "left")
        .groupBy(*placed)
        .agg(F.min("shipped").alias("stop_date"))
    )
    deadline = F.date_add("start_date", _days_allowed(F.col("indicator")))
    return (
        first.withColumn("deadline", deadline)
        .select(
            "case_id",
            "indicator",
            "start_date",
            "stop_date",
            F.col("stop_date").alias("end_date"),
            "deadline",
            F.col("deadline").alias("agg_deadline"),
            F.when(F.col("stop_date") <= F.col("deadline"), 1)
            .when(F.col("stop_date") > F.col("deadline"), 0)
            .alias("on_time"),
            F.datediff("stop_date", "start_date").cast("double").alias("duration"),
        )
    )


def order_milestones(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a milestone named by its return flag and line status."""
    return _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("case_id"),
        F.concat("l_returnflag", "l_linestatus").alias("milestone"),
        F.col("l_shipdate").cast("date").alias("milestone_ts"),
    )
