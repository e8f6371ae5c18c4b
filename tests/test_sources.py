"""Balanced slices of a database read, rows that keep their names, listings of files."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablemend.operators import list_files, with_listed_presence, with_presence
from tablemend.sources import jdbc


def _slice_sizes(spark, df, column, count):
    bounds = jdbc.slice_bounds(df, column, count)
    conditions = jdbc.slice_predicates(column, bounds, quote="`")
    sizes = df.agg(*(F.count_if(F.expr(c)).alias(f"s{i}") for i, c in enumerate(conditions))).first()
    assert sum(sizes) == df.count()
    return list(sizes)


def test_slices_of_a_skewed_column_are_balanced(spark):
    # Nine tenths of the keys lie in a hundredth of their range.
    pick = random.Random(1)
    keys = [pick.randrange(1000) if pick.random() < 0.9 else pick.randrange(100_000) for _ in range(20_000)]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    sizes = _slice_sizes(spark, df, "id", 8)
    assert len(sizes) == 8 and max(sizes) <= 2 * min(sizes)


def test_slices_of_odd_columns(spark):
    df = spark.createDataFrame([(None,), (5,), (5,), (5,), (5,), (9,)], "id int")
    assert sum(_slice_sizes(spark, df, "id", 4)) == 6
    empty = df.where("false")
    assert jdbc.slice_bounds(empty, "id", 4) == [] and jdbc.slice_predicates("id", []) == ["1 = 1"]
    assert jdbc.slice_bounds(df, "id", 1) == []
    days = spark.range(100).select(F.expr("date_add(DATE'2020-01-01', CAST(id AS INT))").alias("d"))
    assert max(_slice_sizes(spark, days, "d", 4)) <= 27
    assert jdbc.slice_predicates('a"b', [date(2020, 1, 2), date(2020, 2, 1)]) == [
        '"a""b" <= DATE \'2020-01-02\' OR "a""b" IS NULL',
        '"a""b" > DATE \'2020-01-02\' AND "a""b" <= DATE \'2020-02-01\'',
        '"a""b" > DATE \'2020-02-01\'',
    ]
    assert jdbc.slice_predicates("t", [datetime(2020, 1, 1, 2)])[1] == "\"t\" > TIMESTAMP '2020-01-01 02:00:00'"
    with pytest.raises(TypeError):
        jdbc.slice_predicates("t", ["x'; DROP TABLE t"])


def test_rows_keep_their_names(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 AS k", "'x' AS t").repartition(5)
    rows = jdbc.numbered_rows(df, str(tmp_path))
    first = rows.collect()
    assert len({r[jdbc.ROW_NUMBER] for r in first}) == 1000 and rows.columns == ["k", "t", jdbc.ROW_NUMBER]
    again = rows.repartition(3, "k").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, first))


def _tree(folder):
    for name in ("a/b/c/1.jpg", "a/b/2.jpg", "a/3 ü.jpg", "4.jpg", "d/5.jpg"):
        file = folder / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x" * len(name))
    (folder / "empty").mkdir()


def test_a_listing_has_every_file_once(spark, tmp_path):
    _tree(tmp_path / "files")
    files = list_files(spark, str(tmp_path / "files"), str(tmp_path / "work"), tasks=2)
    got = {r.path: (r.length, r.folder) for r in files.collect()}
    assert got == {
        "a/b/c/1.jpg": (11, "a/b/c"), "a/b/2.jpg": (9, "a/b"), "a/3 ü.jpg": (9, "a"), "4.jpg": (5, ""), "d/5.jpg": (7, "d"),
    }
    levels = [spark.read.parquet(str(p)) for p in (tmp_path / "work").glob("run-*/level-*")]
    assert sum(level.where("is_folder").count() for level in levels) == 5  # requests beside the first
    assert list_files(spark, str(tmp_path / "none"), str(tmp_path / "work"), tasks=1).count() == 0


def test_presence_by_listing_equals_presence_by_request(spark, tmp_path):
    _tree(tmp_path / "files")
    paths = ["a/b/c/1.jpg", "a/b", "a", "a/3 ü.jpg", "./4.jpg", "a//b/./2.jpg", "a/../4.jpg", "/4.jpg", "", "x.jpg", None, "4.jpg", "4.jpg", "a.b/1"]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, length_of int")
    base = str(tmp_path / "files")
    want = with_presence(df, base, tasks=2)
    got = with_listed_presence(df, list_files(spark, base, str(tmp_path / "work"), tasks=2))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
