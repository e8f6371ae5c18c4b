from tablemend.sources.files import (
    read_csv,
    read_table,
    read_tables,
    write_csv,
    write_quarantine,
    write_table,
    write_tables,
)

__all__ = [
    "read_csv",
    "read_table",
    "read_tables",
    "write_csv",
    "write_quarantine",
    "write_table",
    "write_tables",
]
