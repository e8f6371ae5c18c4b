"""Projections to declared and to target columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tablemend.contract import Catalog, ContractError, TableSpec
from tablemend.functions.text import quoted


def declared_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Only the declared columns, in declared order."""
    spec.check(df.schema, types=False)
    return df.select([quoted(c) for c in spec.columns])


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names the table does not have are ignored."""
    return df.drop(*names)


def target_columns(headers: Sequence[str], spec: TableSpec, joined: Sequence[TableSpec] = ()) -> dict[str, str]:
    """Target column -> source column.

    The main table's columns come first, in declared order and with its key
    named ``id``; then the columns of joined tables without their keys. Where a
    name occurs twice the first wins; columns not in ``headers`` are left out.
    """
    missing = [k for k in spec.primary_key if k not in headers]
    if missing:
        raise ContractError(f"{spec.name}: key {missing} is not among the columns")
    columns: dict[str, str] = {}
    for name in spec.columns:
        if name in spec.primary_key:
            columns.setdefault("id", name)
        elif name in headers:
            columns.setdefault(name, name)
    for dependent in joined:
        for name in dependent.columns:
            if name not in dependent.primary_key and name in headers:
                columns.setdefault(name, name)
    return columns


def project_to_target(df: DataFrame, spec: TableSpec, joined: Sequence[TableSpec] = ()) -> DataFrame:
    """The table as its target wants it."""
    return df.selectExpr(
        *[f"{quoted(s)} AS {quoted(t)}" for t, s in target_columns(df.columns, spec, joined).items()]
    )


def project_all(catalog: Catalog, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Project every table, under its target name; joined tables are taken from the join map."""
    joins = catalog.join_map()
    out = {}
    for name, df in tables.items():
        joined = [catalog[d] for d in joins.get(name, ()) if d not in tables]
        out[catalog[name].target_name] = project_to_target(df, catalog[name], joined)
    return out
