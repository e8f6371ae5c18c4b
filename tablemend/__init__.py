"""Clean and migrate relational tables with Spark, driven by table contracts."""

from tablemend.contract import (
    CASCADE,
    DO_NOTHING,
    SET_NULL,
    Catalog,
    ContractError,
    ForeignKey,
    JoinInto,
    TableSpec,
    UnknownTableError,
    column,
    table,
)

__all__ = [
    "CASCADE",
    "DO_NOTHING",
    "SET_NULL",
    "Catalog",
    "ContractError",
    "ForeignKey",
    "JoinInto",
    "TableSpec",
    "UnknownTableError",
    "column",
    "table",
]
