"""Files that table columns refer to: list them, look for them, publish them."""

from __future__ import annotations

import re
import shutil
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemend.contract import Catalog
from tablemend.functions.text import is_safe_path, named
from tablemend.operators.dedup import distinct_texts

# The functions handed to mapInArrow run in Python workers that may not have this
# package, so they use nothing of it.

MANIFEST_SCHEMA = "table_name string, column_name string, path string"


def manifest(spark: SparkSession, catalog: Catalog, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct non-blank paths of every asset column: ``(table_name, column_name, path)``.

    A path that several columns hold is listed once for each.
    """
    parts = [
        distinct_texts(tables[name], c).select(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), named(c).alias("path")
        )
        for name, columns in catalog.asset_map().items()
        if name in tables
        for c in columns
    ]
    if not parts:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _arrow_uri(uri: str) -> str:
    """A folder as Hadoop names it, in the form Arrow's file systems take."""
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def _spread(paths: DataFrame, tasks: int | None) -> DataFrame:
    """Deal paths out evenly. Next to the files the table of paths is tiny and would end up in very few tasks."""
    tasks = tasks or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.withColumn("__safe", F.coalesce(is_safe_path(F.col("path")), F.lit(False))).repartition(tasks)


def with_presence(paths: DataFrame, base_uri: str, tasks: int | None = None, threads: int = 8) -> DataFrame:
    """Add ``present`` and ``length`` by looking each path up below a base folder.

    ``base_uri`` is a path or URI every executor can read. The tasks ask for
    their own paths, ``threads`` at a time; the folder is never listed, so
    neither its size nor the number of paths reaches the driver. Paths that
    would leave the base folder are not looked up and count as absent, and so do
    folders: an asset is a file.
    """
    schema = StructType(list(paths.schema.fields)).add("present", "boolean").add("length", "long")
    base_uri = _arrow_uri(base_uri)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(base_uri)
        base = base.rstrip("/")
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                table = pa.Table.from_batches([batch])
                asked = zip(table.column("path").to_pylist(), table.column("__safe").to_pylist(), strict=True)
                infos = list(pool.map(lambda a: filesystem.get_file_info(f"{base}/{a[0]}") if a[1] else None, asked))
                present = [i is not None and i.type == fs.FileType.File for i in infos]
                lengths = [i.size if ok else None for i, ok in zip(infos, present)]
                table = table.drop_columns(["__safe"])
                table = table.append_column("present", pa.array(present, pa.bool_()))
                table = table.append_column("length", pa.array(lengths, pa.int64()))
                yield from table.to_batches()

    return _spread(paths, tasks).mapInArrow(look_up, schema)


LISTING_SCHEMA = "path string, length long, folder string"


def list_files(spark: SparkSession, base_uri: str, work_dir: str, tasks: int | None = None) -> DataFrame:
    """All files below a folder: ``(path, length, folder)``, paths relative to it.

    The tasks list the folders, one request each, level by level; every level is
    written below ``work_dir`` and names the folders of the next. So the requests
    grow with the folders, not with the files, and no listing reaches the
    driver. A folder is listed by one task. A missing base folder has no files.
    """
    base_uri, run = _arrow_uri(base_uri), f"{work_dir.rstrip('/')}/run-{uuid4().hex}"
    found_schema = "folder string, path string, length long, is_folder boolean"
    target = pa.schema([("folder", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("is_folder", pa.bool_())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(base_uri)
        base = base.rstrip("/")
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                selector = fs.FileSelector(f"{base}/{folder}".rstrip("/") or "/", allow_not_found=True)
                infos = filesystem.get_file_info(selector)
                columns = (
                    [folder] * len(infos),
                    [i.path[len(base) + 1 :] for i in infos],
                    [i.size for i in infos],
                    [i.type == fs.FileType.Directory for i in infos],
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders, levels = spark.createDataFrame([("",)], "path string"), []
    while True:
        path = f"{run}/level-{len(levels)}"
        folders.select("path").repartition(tasks).mapInArrow(look, found_schema).write.parquet(path)
        levels.append(path)
        folders = spark.read.schema(found_schema).parquet(path).where("is_folder")
        if folders.isEmpty():
            break
    return spark.read.schema(found_schema).parquet(*levels).where("NOT is_folder").select("path", "length", "folder")


def with_listed_presence(paths: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``present`` and ``length`` by joining paths to a listing, as ``list_files`` gives it.

    For many paths in few folders this takes far fewer requests than
    :func:`with_presence`, and gives the same rows: unsafe paths count as absent,
    and so do folders; an empty step or ``.`` in a path is no step.
    """
    step = F.regexp_replace(F.regexp_replace("path", "(?:^|(?<=/))(?:\\.?/+)+", ""), "/{2,}", "/")
    asked = paths.withColumn("__file", F.when(is_safe_path(F.col("path")), step))
    listed = files.select(F.col("path").alias("__listed"), "length").distinct()
    found = asked.join(listed, F.expr("__file = __listed"), "left")
    present = F.col("__listed").isNotNull().alias("present")
    return found.select(*(F.col(f"`{c}`") for c in paths.columns), present, "length")


def publish(
    paths: DataFrame,
    base_uri: str,
    destination_uri: str,
    report_path: str,
    tasks: int | None = None,
    threads: int = 8,
) -> DataFrame:
    """Copy the files behind the distinct ``path`` values; returns the written report.

    The report has ``(path, status, error, length)``, status one of ``copied``,
    ``missing``, ``rejected`` and ``failed``; a file that cannot be copied never
    fails the job, and a folder is no file (``missing``). The key at the
    destination is the relative path, so a task that runs again after a lost
    executor writes the same files again. A file gets its key only when it is
    whole: it is written beside it, its size compared, and then moved. The report
    is written once and read back: reading it repeats no copy. ``length`` is the
    number of bytes at the destination.

    ``tasks`` is the number of copying tasks, by default the session's shuffle
    partitions; each copies ``threads`` files at a time, in pieces of 1 MB.
    """
    spark = paths.sparkSession
    base_uri, destination_uri = _arrow_uri(base_uri), _arrow_uri(destination_uri)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, base = fs.FileSystem.from_uri(base_uri)
        target, target_base = fs.FileSystem.from_uri(destination_uri)
        base, target_base = base.rstrip("/"), target_base.rstrip("/")
        has_folders = target.type_name not in ("s3", "gcs", "abfs")

        def copy_whole(origin: str, key: str, size: int) -> int:
            part = f"{key}.part-{uuid4().hex}"
            try:
                with source.open_input_stream(origin) as src, target.open_output_stream(part) as dst:
                    shutil.copyfileobj(src, dst, 1 << 20)
                written = target.get_file_info(part).size
                if written != size:
                    raise OSError(f"{written} of {size} bytes were copied")
                target.move(part, key)
                return written
            except BaseException:
                if target.get_file_info(part).type == fs.FileType.File:
                    target.delete_file(part)
                raise

        def copy_one(row: dict) -> dict:
            path = row["path"]
            report = {"path": path, "status": "rejected", "error": None, "length": None}
            if not row["__safe"]:
                return report
            try:
                info = source.get_file_info(f"{base}/{path}")
                if info.type != fs.FileType.File:
                    return {**report, "status": "missing"}
                key = f"{target_base}/{path}"
                if has_folders:
                    target.create_dir(key.rsplit("/", 1)[0], recursive=True)
                if target.get_file_info(key).type == fs.FileType.Directory:
                    raise IsADirectoryError(key)
                return {**report, "status": "copied", "length": copy_whole(f"{base}/{path}", key, info.size)}
            except Exception as e:  # a file that cannot be copied is a row, not a failed job
                return {**report, "status": "failed", "error": f"{type(e).__name__}: {e}"}

        schema = pa.schema(
            [("path", pa.string()), ("status", pa.string()), ("error", pa.string()), ("length", pa.int64())]
        )
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                yield pa.RecordBatch.from_pylist(list(pool.map(copy_one, batch.to_pylist())), schema)

    report_schema = "path string, status string, error string, length long"
    work = _spread(paths.select("path").distinct(), tasks)
    work.mapInArrow(copy, report_schema).write.mode("overwrite").parquet(report_path)
    return spark.read.schema(report_schema).parquet(report_path)


def publish_counts(report: DataFrame) -> DataFrame:
    """Files per status."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
