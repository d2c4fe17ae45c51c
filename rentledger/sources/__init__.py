"""Reading, making and writing tables."""

from rentledger.sources.shared import durable, scratch, shared_dir, shuffles_freed
from rentledger.sources.tables import (
    append,
    append_to,
    bind,
    create_as,
    load,
    row_count,
    rows,
    save_all,
    sequence_table,
    table_size,
    truncate,
    with_defaults,
)

__all__ = [
    "append",
    "append_to",
    "bind",
    "create_as",
    "durable",
    "load",
    "row_count",
    "rows",
    "save_all",
    "scratch",
    "sequence_table",
    "shared_dir",
    "shuffles_freed",
    "table_size",
    "truncate",
    "with_defaults",
]
