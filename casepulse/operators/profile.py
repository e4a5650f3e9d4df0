"""Size and range of an input, as the jobs report before they start."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(
    df: DataFrame, *, by: Sequence[str] = (), distinct: Sequence[str] = (), ranges: Sequence[str] = ()
) -> DataFrame:
    """Row count, distinct counts and value ranges, per group of ``by``."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        *[F.count_distinct(name).alias(f"n_{name}") for name in distinct],
        *[bound(name).alias(f"{label}_{name}") for name in ranges for label, bound in (("min", F.min), ("max", F.max))],
    )


def series_profile(series: DataFrame) -> DataFrame:
    """Indicators and periods behind each metric."""
    return profile(series, by=("metric", "granularity"), distinct=("indicator", "period"), ranges=("period",))
