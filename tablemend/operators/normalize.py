"""Bring a raw table to its declared columns, values and types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructField

from tablemend.contract import Catalog, TableSpec
from tablemend.functions.rules import apply_rule
from tablemend.functions.text import named


def _ruled(df: DataFrame, field: StructField) -> Column:
    return apply_rule(
        field.metadata.get("rule"), named(field.name), df.schema[field.name].dataType, field.metadata.get("args")
    )


# What a cast to a whole number accepts, with the blanks and control characters it trims.
_WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"


def _fitted(value: Column, arrives: DataType, wanted: DataType) -> Column:
    """The value as the wanted type, or NULL. Texts that are plainly no number are not tried: a failed cast is dear."""
    if isinstance(arrives, StringType) and isinstance(wanted, IntegralType):
        value = F.when(value.rlike(_WHOLE), value)
    return value.try_cast(wanted)


def _ruled_type(df: DataFrame, field: StructField) -> DataType:
    return df.select(_ruled(df, field)).schema[0].dataType


def normalize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply every column's rule, cast to the declared type and keep the declared order.

    One projection, so it stays inside the scan's stage. A value that does not
    fit its type fails the job; use :func:`rejects` to find such rows and
    ``lenient=True`` in :func:`normalize_lenient` to set them to NULL.
    """
    spec.check(df.schema, types=False)
    return df.select(
        [_ruled(df, f).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in spec.schema]
    )


def normalize_lenient(df: DataFrame, spec: TableSpec) -> DataFrame:
    """As :func:`normalize`, with NULL in place of a value that does not fit its type."""
    spec.check(df.schema, types=False)
    return df.select(
        [
            _fitted(_ruled(df, f), _ruled_type(df, f), f.dataType).alias(f.name, metadata=f.metadata)
            for f in spec.schema
        ]
    )


def rejects(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw rows with a value that does not fit its declared type; ``_columns`` names the columns at fault."""
    spec.check(df.schema, types=False)
    unfit = {}
    for field in spec.schema:
        value = _ruled(df, field)
        unfit[field.name] = value.isNotNull() & _fitted(value, _ruled_type(df, field), field.dataType).isNull()
    at_fault = [F.when(flag, F.lit(name)) for name, flag in unfit.items()]
    # A list of one, so that the condition reads the finished value and no rule or cast is made twice.
    listed = df.select("*", F.explode(F.array(F.concat_ws(",", *at_fault))).alias("_columns"))
    return listed.where("_columns <> ''")


def normalize_all(catalog: Catalog, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: normalize(df, catalog[name]) for name, df in tables.items()}
