"""Left joins that fold dependent tables into their main table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.contract import Catalog, ContractError
from tablemend.functions.text import quoted
from tablemend.operators.keys import with_key_not_in

Collisions = Literal["raise", "suffix", "first"]

_KEY = "__dependent_key"


def left_join(
    main: DataFrame,
    dependent: DataFrame,
    on: str,
    dependent_key: str | None = None,
    collisions: Collisions = "raise",
    suffix: str = "_right",
    unique_key: bool = True,
) -> DataFrame:
    """All rows of ``main`` with the columns of the matching ``dependent`` rows.

    The dependent's key column is not repeated. Columns both sides have raise
    an error, get ``suffix``, or keep the main table's value (``first``).

    A left join lets adaptive execution split a hot key on the main side only.
    Where the dependent's key may repeat without limit, ``unique_key=False``
    writes the join as matched rows plus unmatched rows: an inner join can be
    split on both sides.
    """
    dependent_key = dependent_key or on
    shared = [c for c in dependent.columns if c != dependent_key and c in main.columns]
    if shared and collisions == "raise":
        raise ContractError(f"columns on both sides of the join: {shared}")
    right = dependent.withColumnRenamed(dependent_key, _KEY)
    if shared and collisions == "first":
        right = right.drop(*shared)
    elif shared:
        right = right.withColumnsRenamed({c: c + suffix for c in shared})

    match = F.expr(f"{quoted(on)} = {_KEY}")
    if unique_key:
        return main.join(right, match, "left").drop(_KEY)

    matched = main.join(right, match, "inner").drop(_KEY)
    unmatched = with_key_not_in(main, [on], right, [_KEY])
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name != _KEY}
    return matched.unionByName(unmatched.withColumns(nulls))


def join_all(
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    collisions: Collisions = "first",
) -> dict[str, DataFrame]:
    """Fold every table with a ``join_to`` into its main table, in catalog order.

    Dependents leave the output. A main table that is not at hand is skipped; a
    missing dependent of one that is raises ``KeyError``.
    """
    out = dict(tables)
    for main, dependents in catalog.join_map().items():
        if main not in out:
            continue
        for name in dependents:
            if name not in tables:
                raise KeyError(f"{name} is to be joined into {main} but is not among the tables")
            spec = catalog[name]
            on = spec.join_to.on or catalog[main].key_column
            key = spec.key_column if spec.join_to.on else on
            out[main] = left_join(
                out[main], tables[name], on, key, collisions, unique_key=spec.primary_key == (key,)
            )
        for name in dependents:
            out.pop(name, None)
    return out
