"""Checks of the limits a contract declares, defaults, key uniqueness and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.contract import TableSpec
from tablemend.functions.text import named


def _checks(spec: TableSpec) -> list[tuple[str, str, Column]]:
    checks = []
    for field in spec.schema:
        value, facts = named(field.name), field.metadata
        if not field.nullable:
            checks.append((field.name, "not_null", value.isNull()))
        if "max_length" in facts:
            checks.append((field.name, "max_length", F.length(value) > facts["max_length"]))
        low, high = facts.get("min_value"), facts.get("max_value")
        if low is not None or high is not None:
            outside = F.lit(False)
            if low is not None:
                outside = outside | (value < F.lit(low))
            if high is not None:
                outside = outside | (value > F.lit(high))
            checks.append((field.name, "range", outside))
    return checks


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per value that breaks a declared limit: key columns, ``column_name``, ``check_name``, ``value``.

    All checks are made in one pass over the columns they need.
    """
    faults = [
        F.when(
            broken,
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(check).alias("check_name"),
                named(name).cast("string").alias("value"),
            ),
        )
        for name, check, broken in _checks(spec)
    ]
    keys = [named(k) for k in spec.primary_key]
    if not faults:
        return df.where(F.lit(False)).select(
            *keys, *[F.lit("").alias(c) for c in ("column_name", "check_name", "value")]
        )
    # Most rows break nothing: they are left out before any is multiplied.
    found = df.where(reduce(lambda a, b: a | b, (broken for _, _, broken in _checks(spec))))
    return found.select(*keys, F.explode(F.array_compact(F.array(*faults))).alias("__fault")).select(*keys, "__fault.*")


def fill_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Put the declared default where a column with one is NULL."""
    defaults = {f.name: f for f in spec.schema if "default" in f.metadata}
    return df.select(
        [
            F.coalesce(named(c), F.lit(defaults[c].metadata["default"]).cast(df.schema[c].dataType)).alias(
                c, metadata=df.schema[c].metadata
            )
            if c in defaults
            else named(c)
            for c in df.columns
        ]
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*[named(k) for k in key]).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per column: type, rows, NULLs, and the value in the row with the smallest key.

    A table without a declared key goes by its first column. It is a single
    aggregation without groups, so each task passes on one small row.
    """
    key = F.struct(*[named(k) for k in spec.primary_key or df.columns[:1]])
    first = F.struct(*[named(name).alias(f"v{i}") for i, name in enumerate(df.columns)])
    aggregates = [F.count(F.lit(1)).alias("n_rows"), F.min_by(first, key).alias("first")]
    for i, name in enumerate(df.columns):
        aggregates.append(F.count_if(named(name).isNull()).alias(f"n_null_{i}"))
    rows = [
        F.struct(
            F.lit(spec.name).alias("table_name"),
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("type_name"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.col("n_rows"),
            F.col(f"n_null_{i}").alias("n_null"),
            F.col(f"first.v{i}").cast("string").alias("first_value"),
        )
        for i, field in enumerate(df.schema)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))
