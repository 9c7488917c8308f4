"""Landing files, catalog tables and the current-state table."""

from tidemark.sources.current import CurrentTable
from tidemark.sources.landing import (
    infer_landing,
    read_landing,
    read_landing_with_corrupt,
    read_quarantine,
    select_malformed,
    split_malformed,
    stream_landing,
    write_landing,
    write_quarantine,
)
from tidemark.sources.tables import (
    append_table,
    drop_table,
    ensure_database,
    ensure_table,
    overwrite_table,
    read_table,
    stream_table,
)

__all__ = [
    "CurrentTable",
    "append_table",
    "drop_table",
    "ensure_database",
    "ensure_table",
    "infer_landing",
    "overwrite_table",
    "read_landing",
    "read_landing_with_corrupt",
    "read_quarantine",
    "read_table",
    "select_malformed",
    "split_malformed",
    "stream_landing",
    "stream_table",
    "write_landing",
    "write_quarantine",
]
