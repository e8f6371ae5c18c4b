"""Parquet and CSV in and out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablemend.contract import Catalog

# How a bulk load reads text: NULL is an empty field, an empty text is "", a
# quote inside a text is doubled, and blanks around a text belong to it.
CSV_OPTIONS = {
    "header": "false",
    "nullValue": "",
    "emptyValue": '""',
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def run_together(jobs: Iterable[Callable[[], None]], at_once: int = 4) -> None:
    """Run independent Spark jobs side by side, so that small tables do not leave the cluster idle."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table. Lazy: columns and filters used later decide what is read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_tables(
    spark: SparkSession,
    catalog: Catalog,
    root: str,
    names: Iterable[str] | None = None,
    pattern: str = "{root}/{table}.parquet",
) -> dict[str, DataFrame]:
    """The named tables, or all of the catalog's, each with its contract's row filter applied."""
    tables = {}
    for name in catalog.subset(names):
        df = read_table(spark, pattern.format(root=root.rstrip("/"), table=name))
        row_filter = catalog[name].row_filter
        tables[name] = df.where(row_filter) if row_filter else df
    return tables


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Iterable[str] = (),
    max_rows_per_file: int | None = None,
) -> None:
    """Write Parquet. Refuses to replace an existing table unless ``mode="overwrite"``."""
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    run_together(
        partial(write_table, df, f"{root.rstrip('/')}/{name}", mode) for name, df in tables.items()
    )


def write_quarantine(quarantine: Mapping[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    """One Parquet table per source table, a folder per foreign key."""
    run_together(
        partial(write_table, df, f"{root.rstrip('/')}/{name}", mode, ("_table", "_fk"))
        for name, df in quarantine.items()
    )


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", chunk_size: int | None = None
) -> None:
    """Write CSV for a bulk load, without header, at most ``chunk_size`` rows per file if given."""
    writer = df.write.mode(mode).options(**CSV_OPTIONS)
    if chunk_size:
        writer = writer.option("maxRecordsPerFile", chunk_size)
    writer.csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what :func:`write_csv` wrote, NULL and empty text apart.

    The reader gives an unquoted empty field the ``nullValue`` text and takes
    any field with that text for NULL, so it must be one that no data holds.
    """
    options = {**CSV_OPTIONS, "nullValue": "\x00NULL\x00", "emptyValue": "", "multiLine": "true"}
    return spark.read.schema(schema).options(**options).csv(path)
