"""Databases in and out, through Spark's JDBC source.

Drivers and credentials come from the caller's ``options`` (``url``, ``user``,
``password``, ``driver``...). This module adds what a table copy needs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.contract import Catalog, TableSpec
from tablemend.functions.text import named
from tablemend.operators.project import project_to_target
from tablemend.sources.files import write_table

# Fixed value: rows fetched or inserted per round trip.
BATCH_ROWS = 5000

# The column that numbers rows in a staging table.
ROW_NUMBER = "_row"

# Settings for a MySQL source: read through a cursor instead of into memory,
# full Unicode, zero dates as NULL (the driver meets them before any rule
# does), and TINYINT(1) as a number, so that int_to_bool sees what was stored.
MYSQL_OPTIONS = {
    "useCursorFetch": "true",
    "characterEncoding": "UTF-8",
    "zeroDateTimeBehavior": "CONVERT_TO_NULL",
    "tinyInt1isBit": "false",
    "sessionInitStatement": "SET SESSION TRANSACTION READ ONLY",
}


@dataclass(frozen=True)
class Slices:
    """A numeric or date column to read in parallel slices."""

    column: str
    lower: str
    upper: str
    count: int


def read_options(
    spec: TableSpec, options: Mapping[str, str], slices: Slices | None = None, fetch_rows: int = BATCH_ROWS
) -> dict[str, str]:
    """The reader options for one table."""
    out = {"fetchsize": str(fetch_rows), **options, "dbtable": spec.name}
    if slices:
        out |= {
            "partitionColumn": slices.column,
            "lowerBound": slices.lower,
            "upperBound": slices.upper,
            "numPartitions": str(slices.count),
        }
    return out


def read_table(
    spark: SparkSession,
    spec: TableSpec,
    options: Mapping[str, str],
    slices: Slices | None = None,
    fetch_rows: int = BATCH_ROWS,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """The declared columns of one database table; Spark asks the database for those only.

    Without ``slices`` or ``predicates`` the table arrives through one
    connection, as one task. Each predicate is a task's condition, see
    :func:`balanced_predicates`.
    """
    if predicates:
        given = read_options(spec, options, None, fetch_rows)
        url, name = given.pop("url"), given.pop("dbtable")
        rows = spark.read.jdbc(url, name, predicates=list(predicates), properties=given)
    else:
        rows = spark.read.format("jdbc").options(**read_options(spec, options, slices, fetch_rows)).load()
    if spec.row_filter:
        rows = rows.where(spec.row_filter)
    return rows.select([named(c) for c in spec.columns])


def slices_of(
    spark: SparkSession, spec: TableSpec, options: Mapping[str, str], column: str, count: int
) -> Slices:
    """Bounds for a parallel read: one row with the column's extremes, computed by the database."""
    rows = spark.read.format("jdbc").options(**read_options(spec, options)).load()
    low, high = rows.agg(F.min(named(column)), F.max(named(column))).first()
    return Slices(column, str(low if low is not None else 0), str(high if high is not None else 0), count)


def slice_bounds(keys: DataFrame, column: str, count: int, accuracy: int = 10_000) -> list:
    """Values that cut a column into up to ``count`` slices with about as many rows each, ascending.

    They come of a quantile sketch, one pass over the column; ``accuracy`` is its
    size, an error of one in so many rows. A value that fills several slices is
    one bound, as no condition on the column divides its rows; then the bounds are fewer.
    """
    places = [i / count for i in range(1, count)]
    if not places:
        return []
    sketch = keys.agg(F.percentile_approx(named(column), places, accuracy))
    return sorted(set(sketch.first()[0] or []))


def slice_predicates(column: str, bounds: Sequence, quote: str = '"') -> list[str]:
    """SQL conditions for the slices between some bounds: every row meets exactly one; NULLs are in the first.

    A slice holds the rows after its lower bound up to its upper one.
    """
    name = quote + column.replace(quote, quote * 2) + quote
    values = [_literal(b) for b in bounds]
    if not values:
        return ["1 = 1"]
    between = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(values, values[1:])]
    return [f"{name} <= {values[0]} OR {name} IS NULL", *between, f"{name} > {values[-1]}"]


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    raise TypeError(f"a slice bound must be a number or a date, not {value!r}")


def balanced_predicates(
    spark: SparkSession,
    spec: TableSpec,
    options: Mapping[str, str],
    column: str,
    count: int,
    quote: str = '"',
) -> list[str]:
    """Conditions for a parallel read in slices of about equal numbers of rows, for :func:`read_table`.

    The column alone is read first, in slices of equal width, and sketched. Where
    its values lie close together in places, slices of equal width would leave
    most of the table to one task.
    """
    widths = slices_of(spark, spec, options, column, count)
    rows = spark.read.format("jdbc").options(**read_options(spec, options, widths)).load()
    return slice_predicates(column, slice_bounds(rows.select(named(column)), column, count), quote)


def write_options(
    options: Mapping[str, str], table: str, connections: int, batch_rows: int = BATCH_ROWS
) -> dict[str, str]:
    """The writer options for one table. ``connections`` bounds the load on the database."""
    return {
        "batchsize": str(batch_rows),
        **options,
        "dbtable": table,
        "numPartitions": str(connections),
    }


def publish_statements(staging: str, table: str, columns: list[str], quote: str = '"') -> list[str]:
    """SQL that moves a filled staging table into its target in one statement, and drops it.

    A row that a repeated task has written twice has the same row number twice, and is inserted once.
    """
    names = ", ".join(quote + c.replace(quote, quote * 2) + quote for c in columns)
    once = f"SELECT DISTINCT {quote}{ROW_NUMBER}{quote}, {names} FROM {staging}"
    return [f"INSERT INTO {table} ({names}) SELECT {names} FROM ({once}) AS staged", f"DROP TABLE {staging}"]


def append_table(
    df: DataFrame,
    table: str,
    options: Mapping[str, str],
    connections: int = 8,
    batch_rows: int = BATCH_ROWS,
    run_sql: Callable[[list[str]], None] | None = None,
    quote: str = '"',
    work_dir: str | None = None,
) -> None:
    """Append rows to an existing database table.

    The rows are dealt out evenly to ``connections`` tasks first. Left to
    itself Spark would merge partitions instead, and so compute the table in
    that few tasks too.

    Spark commits each task on its own, and a task that is run again appends
    again. With ``run_sql``, a function that runs statements in one
    transaction, the rows go to ``<table>_staging`` first (replaced, so a rerun
    starts over) and reach the target in a single ``INSERT ... SELECT``: all of
    the table or none of it. Spark's writer can still repeat a task's rows in
    the staging table when an executor is lost in the middle of a task. The rows
    are numbered before they are dealt out, and the insert takes each number once,
    whether or not the target has a key. With ``work_dir`` (a shared folder) rows are written there
    before that, see :func:`numbered_rows`: a row then keeps its number when what made it runs again.
    """
    if run_sql is None:
        dealt = df.repartition(connections)
        dealt.write.format("jdbc").mode("append").options(
            **write_options(options, table, connections, batch_rows)
        ).save()
        return
    staging = f"{table}_staging"
    numbered = numbered_rows(df, work_dir) if work_dir else df.withColumn(ROW_NUMBER, F.monotonically_increasing_id())
    dealt = numbered.repartition(connections, ROW_NUMBER)
    dealt.write.format("jdbc").mode("overwrite").options(
        **write_options(options, staging, connections, batch_rows)
    ).save()
    run_sql(publish_statements(staging, table, df.columns, quote))


def numbered_rows(df: DataFrame, work_dir: str) -> DataFrame:
    """The rows with a name each, ``ROW_NUMBER``, that is the same whenever a task reads them again.

    Numbers given to the result of a shuffle change when a lost task is repeated
    and its rows come in another order. So the rows are written first, and a
    row's name is its file and its place there, both of which stay.
    """
    path = f"{work_dir.rstrip('/')}/run-{uuid4().hex}"
    write_table(df, path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select("*", F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias(ROW_NUMBER))


def load_tables(
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    append: Callable[[DataFrame, str], None],
    deferred: bool = False,
) -> list[str]:
    """Project every table to its target and append it, referred-to tables first.

    ``append`` gets the projected rows and the target table's name, usually
    :func:`append_table` with its options bound. Returns the targets loaded.
    Tables that refer to each other in a cycle have no such order. They are
    loaded one after another only if ``deferred`` says that the database does not
    check references before all are there.
    """
    joins = catalog.join_map()
    loaded = []
    order = [n for group in catalog.load_groups(tables) for n in group] if deferred else catalog.load_order(tables)
    for name in order:
        spec = catalog[name]
        joined = [catalog[d] for d in joins.get(name, ()) if d not in tables]
        append(project_to_target(tables[name], spec, joined), spec.target_name)
        loaded.append(spec.target_name)
    return loaded
