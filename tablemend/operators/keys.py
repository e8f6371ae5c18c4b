"""Key look-ups that keep their balance when one key holds much of the table.

Every look-up here asks the same question: does this row's key occur among
those keys? The rows are many and wide, the keys are narrow. So

* the key side is made distinct first. Partial aggregation folds copies of a
  key inside each map task, so a hot key costs one row per task, and a key
  that occurs twice never multiplies rows;
* rows without a key (NULL, or 0 where 0 means "not set") can never match.
  They are spread over the shuffle by a hash of the columns named for it, or
  else of the task they come from, instead of meeting in the one partition that
  NULL hashes to. No column is read for that alone;
* both sides also carry that hash as a second join key. For rows with a key it
  is a function of the key, so it changes no match. It does make Spark place an
  exchange directly below the join on both sides, which is the shape in which
  adaptive execution can split a partition that a hot key has made too large.

Whether the key side is broadcast is left to Spark's size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    FractionalType,
    DecimalType,
    IntegralType,
    NumericType,
    StringType,
    StructType,
    TimestampType,
)

from tablemend.contract import ContractError
from tablemend.functions.text import named, quoted


def fk_value(schema: StructType, column: str) -> str:
    """SQL for a foreign key's value: NULL where it is not set, which for numbers includes 0."""
    value = quoted(column)
    return f"nullif({value}, 0)" if isinstance(schema[column].dataType, NumericType) else value


def is_set(schema: StructType, column: str) -> str:
    """SQL condition: the foreign key is set. Written so that it reaches the scan as a filter."""
    value = quoted(column)
    zero = f" AND {value} <> 0" if isinstance(schema[column].dataType, NumericType) else ""
    return f"({value} IS NOT NULL{zero})"


def all_present(columns: Sequence[str]) -> str:
    return "(" + " AND ".join(f"{quoted(c)} IS NOT NULL" for c in columns) + ")"


def _cast_to_shared(values: Sequence[str], mine: Sequence[DataType], theirs: Sequence[DataType]) -> list[str]:
    """Key values in a type both sides share, so that equal keys hash alike."""
    out = []
    for value, my_type, their_type in zip(values, mine, theirs, strict=True):
        if my_type == their_type:
            out.append(value)
        elif isinstance(my_type, IntegralType) and isinstance(their_type, IntegralType):
            out.append(f"CAST({value} AS BIGINT)")
        else:
            raise ContractError(f"key types differ: {my_type.simpleString()} and {their_type.simpleString()}")
    return out


def coded(value: str, data_type: DataType) -> tuple[str, str]:
    """A key value of any type as SQL for a whole number and a text, so that keys of several types fit one table.

    Equal values give equal pairs; :func:`decoded` gives the value back.
    """
    if isinstance(data_type, IntegralType):
        return f"CAST({value} AS BIGINT)", "''"
    if isinstance(data_type, TimestampType):
        return f"unix_micros({value})", "''"
    if isinstance(data_type, BinaryType):
        return "0L", f"hex({value})"
    if isinstance(data_type, FractionalType) and not isinstance(data_type, DecimalType):
        # 0.0 and -0.0 are one key.
        return "0L", f"CAST({value} + 0 AS STRING)"
    return "0L", value if isinstance(data_type, StringType) else f"CAST({value} AS STRING)"


def decoded(whole: str, text: str, data_type: DataType) -> str:
    """SQL for the value behind the pair that :func:`coded` made of it."""
    if isinstance(data_type, TimestampType):
        return f"timestamp_micros({whole})"
    if isinstance(data_type, BinaryType):
        return f"unhex({text})"
    return f"CAST({whole if isinstance(data_type, IntegralType) else text} AS {data_type.simpleString()})"


def check_types(mine: DataType, theirs: DataType) -> None:
    """Raise where keys of two types cannot be compared."""
    _cast_to_shared(["x"], [mine], [theirs])


def _lookup(
    df: DataFrame,
    columns: Sequence[str],
    keys: DataFrame,
    key_columns: Sequence[str],
    how: str,
    spread_by: Sequence[str] | None,
    values: Sequence[str] | None = None,
    tag: str = "__key",
    distinct: bool = True,
) -> DataFrame:
    """Join to the keys. ``values`` stand for ``columns`` where NULL is not the only "no key".

    An empty ``spread_by`` says that every row has a key; None spreads rows
    without one by the task they come from. Semi and anti joins may leave the
    keys as they are (``distinct=False``) where copies are few.
    """
    names = [quoted(f"{tag}_{i}") for i in range(len(columns))]
    hashed = quoted(f"{tag}_hash")
    my_types = [df.schema[c].dataType for c in columns]
    key_types = [keys.schema[c].dataType for c in key_columns]
    mine = _cast_to_shared(values or [quoted(c) for c in columns], my_types, key_types)
    theirs = _cast_to_shared([quoted(c) for c in key_columns], key_types, my_types)
    key_side = keys.where(all_present(key_columns)).selectExpr(
        *[f"{value} AS {name}" for value, name in zip(theirs, names, strict=True)]
    )
    if distinct:
        key_side = key_side.distinct()
    key_side = key_side.selectExpr("*", f"xxhash64({', '.join(names)}) AS {hashed}")
    my_hash = f"xxhash64({', '.join(mine)})"
    task = f"{tag}_task"
    if spread_by is None:
        # The number of a task is the same when the task runs again.
        df = df.withColumn(task, F.spark_partition_id())
    if spread_by is None or spread_by:
        present = " AND ".join(f"{value} IS NOT NULL" for value in mine)
        row_hash = f"xxhash64({', '.join(quoted(c) for c in spread_by or [task])})"
        my_hash = f"CASE WHEN {present} THEN {my_hash} ELSE {row_hash} END"
    match = [f"{hashed} = {my_hash}"] + [f"{name} = {value}" for name, value in zip(names, mine, strict=True)]
    joined = df.join(key_side, F.expr(" AND ".join(match)), how)
    return joined.drop(task) if spread_by is None else joined


def with_key_in(df: DataFrame, columns: Sequence[str], keys: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Rows whose key occurs among ``keys`` (EXISTS)."""
    return _lookup(df.where(all_present(columns)), columns, keys, key_columns, "left_semi", ())


def with_key_not_in(
    df: DataFrame,
    columns: Sequence[str],
    keys: DataFrame,
    key_columns: Sequence[str],
    spread_by: Sequence[str] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Rows whose key does not occur among ``keys`` (NOT EXISTS); a NULL key never occurs.

    ``spread_by`` names the columns that spread rows without a key, by default
    the task they come from does; an empty list says that every row has a key.
    ``distinct=False`` saves an exchange where the keys hardly repeat.
    """
    return _lookup(df, columns, keys, key_columns, "left_anti", spread_by, distinct=distinct)


def mark(
    df: DataFrame,
    column: str,
    value: str,
    keys: DataFrame,
    key_column: str,
    marker: str,
    spread_by: Sequence[str] | None = None,
    missing: bool = False,
) -> DataFrame:
    """Add a boolean: ``value``, SQL over ``column``, occurs among ``keys``.

    With ``missing`` it is instead true where the value is not NULL and does
    not occur.
    """
    tag = f"__{marker}"
    found = f"{quoted(tag + '_0')} IS NOT NULL"
    flag = f"({value} IS NOT NULL AND NOT {found})" if missing else found
    joined = _lookup(df, [column], keys, [key_column], "left", spread_by or None, [value], tag)
    return joined.selectExpr("*", f"{flag} AS {quoted(marker)}").drop(f"{tag}_0", f"{tag}_hash")


def mark_key(df: DataFrame, column: str, keys: DataFrame, key_column: str, marker: str) -> DataFrame:
    """Add a boolean column: does the row's key occur among ``keys``? Row count never changes."""
    return mark(df, column, quoted(column), keys, key_column, marker)


def contains_key(df: DataFrame, column: str, key: object) -> bool:
    """Does one given key occur in a table? Runs a job that stops at the first hit."""
    return not df.where(named(column) == F.lit(key)).isEmpty()
