"""Rounding that gives the same bits on any engine that follows IEEE doubles."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled4(x: Column) -> Column:
    """A non-negative double as a whole number of ten-thousandths, half up (BIGINT)."""
    return F.floor(x * F.lit(1e4) + F.lit(0.5)).cast("bigint")


def round4(x: Column) -> Column:
    """Round a double to four decimals, half away from zero, never giving -0.0."""
    magnitude = scaled4(F.abs(x)).cast("double") / F.lit(1e4)
    return F.when((x < 0) & (magnitude > 0), -magnitude).otherwise(magnitude)
