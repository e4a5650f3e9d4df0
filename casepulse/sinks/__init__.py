"""Result tables: declaration and idempotent writes."""

from casepulse.sinks.tables import (
    create_database,
    create_table,
    overwrite,
    remove_folder,
    replace_partition,
    replace_partitions,
    result_table,
    store_clustered,
)

__all__ = [
    "create_database",
    "create_table",
    "overwrite",
    "remove_folder",
    "replace_partition",
    "replace_partitions",
    "result_table",
    "store_clustered",
]
