"""Inputs: catalog tables, parquet folders and literal dimensions, renamed to one set of columns."""

from casepulse.sources.config import indicator_config
from casepulse.sources.tables import (
    CASE_COLUMNS,
    MILESTONE_COLUMNS,
    read_cases,
    read_milestones,
    read_result,
    standardise,
)

__all__ = [
    "CASE_COLUMNS",
    "MILESTONE_COLUMNS",
    "indicator_config",
    "read_cases",
    "read_milestones",
    "read_result",
    "standardise",
]
