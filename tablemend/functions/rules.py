"""Value rules: named column functions that a contract attaches to columns.

A rule is ``(Column, DataType, **args) -> Column``. It gets the type the column
arrives with, so it can be resolved once per column on the driver and stays a
plain expression in the plan. A value that the rule cannot equal (a number
against a text gauge, say) passes through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

from tablemend.functions.entities import unescape

Rule = Callable[..., Column]

# The texts that stand for "no date".
ZERO_DATES = ("0000-00-00", "0000-00-00 00:00:00")


def to_html(value: Column, data_type: DataType) -> Column:
    """Turn HTML character references into the characters they name, once."""
    return unescape(value) if isinstance(data_type, StringType) else value


def zero_to_none(value: Column, data_type: DataType) -> Column:
    if isinstance(data_type, NumericType):
        return F.nullif(value, F.lit(0))
    if isinstance(data_type, BooleanType):
        return F.nullif(value, F.lit(False))
    return value


def normalize_date(value: Column, data_type: DataType) -> Column:
    if not isinstance(data_type, StringType):
        return value
    return F.when(~value.isin(*ZERO_DATES), value)


def value_to_none(value: Column, data_type: DataType, gauge: Any) -> Column:
    comparable = (
        isinstance(data_type, StringType)
        if isinstance(gauge, str)
        else isinstance(data_type, BooleanType)
        if isinstance(gauge, bool)
        else isinstance(data_type, NumericType)
    )
    return F.when(value != F.lit(gauge), value) if comparable else value


def int_to_bool(value: Column, data_type: DataType) -> Column:
    """Truth value; NULL is false."""
    if isinstance(data_type, BooleanType):
        truth = value
    elif isinstance(data_type, NumericType):
        truth = value != F.lit(0)
    elif isinstance(data_type, StringType):
        truth = F.length(value) > 0
    else:
        truth = value.isNotNull()
    return F.coalesce(truth, F.lit(False))


# The names by which contracts call the rules.
_RULES: dict[str, Rule] = {
    "to_html": to_html,
    "zero_to_none": zero_to_none,
    "normalize_date": normalize_date,
    "value_to_none": value_to_none,
    "int_to_bool": int_to_bool,
}


def register_rule(name: str, rule: Rule) -> None:
    """Add a rule of your own, ``(Column, DataType, **args) -> Column``."""
    _RULES[name] = rule


def apply_rule(name: str | None, value: Column, data_type: DataType, args: dict[str, Any] | None = None) -> Column:
    """Apply a rule by name; no name means the value as it is."""
    if name is None:
        return value
    if name not in _RULES:
        raise KeyError(f"unknown value rule {name!r}; known: {sorted(_RULES)}")
    return _RULES[name](value, data_type, **(args or {}))
