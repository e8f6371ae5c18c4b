"""Duplicate removal and distinct values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, DecimalType, FractionalType, StructType, TimestampType

from tablemend.contract import Catalog
from tablemend.functions.text import has_text, named
from tablemend.sources.files import write_table

Keep = Literal["first", "last", "any", "none"]


@dataclass(frozen=True)
class DedupRule:
    """Which columns make two rows duplicates, and which of them to keep.

    ``order_by`` decides what "first" and "last" mean; by default the table's
    primary key. ``by_digest`` is for long values, see
    :func:`deduplicate_by_digest`; it takes a ``work_dir``.
    """

    subset: tuple[str, ...]
    keep: Keep = "first"
    order_by: tuple[str, ...] = ()
    by_digest: bool = False


def deduplicate(
    df: DataFrame,
    subset: Sequence[str],
    keep: Keep = "first",
    order_by: Sequence[str] = (),
    work_dir: str | None = None,
) -> DataFrame:
    """Keep one row, or none, of every group that agrees on ``subset``. NULLs form a group.

    All four forms shrink each group inside the map tasks before the shuffle:
    ``first``/``last``/``any`` through the group limit Spark derives from
    ``row_number() = 1``, ``none`` by counting the deciding columns alone with
    partial sums. So a text that a third of the rows share is one row per map
    task. ``none`` then drops the repeated values by an anti join, whose large
    side can be split.

    With ``work_dir`` (a shared folder) long values never decide anything
    themselves: see :func:`deduplicate_by_digest`.
    """
    if work_dir is not None:
        return deduplicate_by_digest(df, subset, keep, order_by, work_dir)
    if keep in ("first", "last", "any"):
        if keep == "any":
            order_by = list(subset)[:1]
        if not order_by:
            raise ValueError(f"keep={keep!r} needs order_by: a table has no order of its own")
        ordering = [named(c).asc() if keep != "last" else named(c).desc() for c in order_by]
        window = Window.partitionBy([named(c) for c in subset]).orderBy(ordering)
        return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")
    if keep == "none":
        keys = [named(c).alias(f"__key_{i}") for i, c in enumerate(subset)]
        names = [f"__key_{i}" for i in range(len(keys))]
        counted = df.select(keys).groupBy(*names).agg(F.count(F.lit(1)).alias("__rows"))
        repeated = counted.where("__rows > 1").select(*names)
        same = [named(c).eqNullSafe(F.col(n)) for c, n in zip(subset, names, strict=True)]
        return df.join(repeated, reduce(lambda a, b: a & b, same), "left_anti")
    raise ValueError(f"keep must be first, last, any or none, not {keep!r}")


def _code(name: str, schema: StructType) -> Column:
    """A value as bytes: equal values, and only those, give equal bytes."""
    value, kind = named(name), schema[name].dataType
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        value = value + F.lit(0.0)  # 0.0 and -0.0 are equal
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value).cast("string").cast("binary")  # a text would go by the time zone
    elif isinstance(kind, BinaryType):
        value = value.cast("binary")
    elif isinstance(kind, AtomicType):
        value = value.cast("string").cast("binary")
    else:
        value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}).cast("binary")
    length = F.format_string("%d:", F.octet_length(value)).cast("binary")
    return F.when(named(name).isNull(), F.lit(b"-")).otherwise(F.concat(length, value))


def digest(subset: Sequence[str], schema: StructType) -> Column:
    """A digest of some columns, NULLs told apart from texts: 256 bits, of which no two different inputs are known to agree."""
    return F.unhex(F.sha2(F.concat(*(_code(c, schema) for c in subset)), 256))


def deduplicate_by_digest(
    df: DataFrame, subset: Sequence[str], keep: Keep, order_by: Sequence[str], work_dir: str
) -> DataFrame:
    """The same by a SHA-256 digest of the deciding columns, for columns with long values.

    A first pass, which runs now, shuffles ``(digest, order_by)`` alone and
    writes the digests that occur more than once, each with the place of the row
    to keep. Rows are then looked up in that list: one narrow row for each
    repeated group, however large the group is. Spark knows the list's size; a
    short one is broadcast, and no row is shuffled. A long one is joined by
    shuffle, on the digest, and a hot group of rows can be split there.

    Where several rows of a group are first by ``order_by``, the list says so,
    and only they are brought together to pick one. ``any`` goes by a hash of the
    whole row, which ties only where rows are equal.
    """
    if keep not in ("first", "last", "any", "none"):
        raise ValueError(f"keep must be first, last, any or none, not {keep!r}")
    marked = df.withColumn("__digest", digest(subset, df.schema))
    if keep == "any":
        place = F.struct(F.xxhash64(*(named(c) for c in df.columns)).alias("o"))
    elif keep == "none":
        place = F.struct(F.lit(0).alias("o"))
    elif order_by:
        place = F.struct(*(named(c).alias(f"o{i}") for i, c in enumerate(order_by)))
    else:
        raise ValueError(f"keep={keep!r} needs order_by: a table has no order of its own")
    marked = marked.withColumn("__place", place)
    best = F.max if keep == "last" else F.min
    repeated = (
        marked.groupBy("__digest", "__place")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("__digest")
        .agg(F.sum("rows").alias("rows"), best(F.struct("__place", "rows")).alias("best"))
        .where("rows > 1")
        .select(
            F.col("__digest").alias("__repeated"), F.col("best.__place").alias("__best"), F.col("best.rows").alias("__ties")
        )
    )
    path = f"{work_dir.rstrip('/')}/run-{uuid4().hex}"
    write_table(repeated, path)
    repeated = df.sparkSession.read.schema(repeated.schema).parquet(path)
    same = F.col("__digest") == F.col("__repeated")
    if keep == "none":
        return marked.join(repeated, same, "left_anti").drop("__digest", "__place")
    found = marked.join(repeated, same, "left")
    first = found.where(F.col("__repeated").isNull() | F.col("__place").eqNullSafe(F.col("__best")))
    added = ("__digest", "__place", "__repeated", "__best", "__ties")
    if repeated.where("__ties > 1").isEmpty():
        return first.drop(*added)
    tied = first.where("__ties > 1").withColumn("__rank", F.row_number().over(Window.partitionBy("__digest").orderBy(F.lit(1))))
    alone = first.where("__ties IS NULL OR __ties = 1").drop(*added)
    return alone.unionByName(tied.where("__rank = 1").drop(*added, "__rank"))


def deduplicate_all(
    catalog: Catalog, tables: Mapping[str, DataFrame], rules: Mapping[str, DedupRule], work_dir: str | None = None
) -> dict[str, DataFrame]:
    """Apply the rule of every table that has one; the others pass through."""
    out = dict(tables)
    for name, rule in rules.items():
        if name not in out:
            continue
        if rule.by_digest and work_dir is None:
            raise ValueError(f"{name}: removing duplicates by digest needs a work_dir")
        order_by = rule.order_by or catalog[name].primary_key
        out[name] = deduplicate(out[name], rule.subset, rule.keep, order_by, work_dir if rule.by_digest else None)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, NULL included."""
    return df.select(named(column)).distinct()


def distinct_texts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one text column that hold more than white space, untrimmed."""
    return df.select(named(column)).where(has_text(named(column))).distinct()
