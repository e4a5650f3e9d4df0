"""The indicator target dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from casepulse.schemas import INDICATOR_CONFIG

# Indicator, target in weeks, red limit, amber limit.
INDICATOR_TARGETS: tuple[tuple[str, int, float, float], ...] = (
    ("Byggesak 3 uker", 3, 0.70, 0.90),
    ("Byggesak 12 uker", 12, 0.70, 0.90),
    ("Delesak 3 uker", 3, 0.70, 0.90),
    ("Delesak 12 uker", 12, 0.70, 0.90),
    ("Seksjonering", 12, 0.70, 0.90),
    ("Oppmåling", 18, 0.70, 0.90),
    ("Offentlig ettersyn privat plan", 12, 0.70, 0.90),
    ("Til politisk behandling", 18, 0.70, 0.90),
    ("Sykefravær", 6, 0.70, 0.90),
    ("Turnover", 6, 0.70, 0.90),
    ("AML", 0, 0.70, 0.90),
)


def indicator_config(
    spark: SparkSession, targets: Iterable[tuple[str, int, float, float]] = INDICATOR_TARGETS
) -> DataFrame:
    """One row per indicator: target weeks and the red and amber limits of its on-time rate."""
    return spark.createDataFrame(list(targets), INDICATOR_CONFIG)
