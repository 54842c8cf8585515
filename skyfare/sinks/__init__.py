"""Tables: create, rebuild, append, load by high-water mark, upsert."""

from skyfare.sinks.tables import (
    above_high_water,
    aligned,
    append,
    append_evolving,
    as_view,
    ensure_table,
    incremental,
    laid_out,
    materialize,
    partition_columns,
    replace_partitions,
    replace_table,
    table_exists,
    upsert,
)

__all__ = [
    "above_high_water",
    "aligned",
    "append",
    "append_evolving",
    "as_view",
    "ensure_table",
    "incremental",
    "laid_out",
    "materialize",
    "partition_columns",
    "replace_partitions",
    "replace_table",
    "table_exists",
    "upsert",
]
