"""What several of the operators need: inputs, shared tables, worker functions, models."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator
from typing import TypeVar
from uuid import uuid4

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemend.plans import shared_folder

#: Row numbers that are sent to all executors at most (16 MB); more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Rows in an Arrow batch. Batches of long texts stay small enough for a worker.
BATCH_ROWS = "1000"


def ship(module: str) -> None:
    """Send the functions of a module to the workers by value: they may not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


T = TypeVar("T")


def share(spark: SparkSession, value: object, make: Callable[..., T] = lambda x: x) -> Callable[[], T]:
    """Broadcast a value, by value like the functions. A task gets ``make(value)``, made once."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    made: list = []

    def get() -> T:
        if not made:
            made.append(make(pickle.loads(sent.value)))
        return made[0]

    return get


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/llm-{uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: what an executor loses is read again, not made again."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` alone, so that no other column travels or clashes; a null text is empty."""
    return df.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def numbered(df: DataFrame, key: str = "doc_id", text: str = "text", all_columns: bool = False) -> DataFrame:
    """``(key, row, text)``, with a number of its own for every row, and with ``columns``, a struct of all, if asked for.

    Keys that are unique whole numbers serve as numbers. Otherwise the rows are numbered and written, so that the
    numbers stay. A null text is empty.
    """
    text_of = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    rest = [F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("columns")] if all_columns else []
    counts = df.agg(F.count("*").alias("rows"), F.count_distinct(F.col(key)).alias("keys")).first()
    whole = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    if whole and counts["rows"] == counts["keys"]:
        return df.select(F.col(key).alias("key"), F.col(key).cast("long").alias("row"), text_of, *rest)
    return stored(df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), text_of, *rest))


def only(df: DataFrame, rows: DataFrame, on: str) -> DataFrame:
    """The rows of ``df`` whose ``on`` is among ``rows``, a written table. It is broadcast if its size allows it."""
    small = rows.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(rows) if small else rows, on, "left_semi")


def in_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str | StructType
) -> DataFrame:
    """Apply a function to every Arrow batch of a frame. It gives the columns of the result."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    target = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    arrow = arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c := made[f.name], pa.Array) else pa.array(c, f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, target)


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``: the fixed fold of a document."""
    return F.crc32(F.col(key).cast("string")) % parts


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, picked by a hash of the key, so the same rows are picked again."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(rows)
