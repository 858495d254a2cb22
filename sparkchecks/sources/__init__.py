"""Table sources and result sinks."""

from .sinks import write_table
from .tables import CatalogTables, FileTables, FrameTables, JdbcTables, Tables, local_rows, split_name

__all__ = [
    "CatalogTables",
    "FileTables",
    "FrameTables",
    "JdbcTables",
    "Tables",
    "local_rows",
    "split_name",
    "write_table",
]
