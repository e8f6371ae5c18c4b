"""Look-ups: results by brute force, and plans that can split a hot key."""

import contextlib
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablemend import CASCADE, SET_NULL, ContractError, column, table
from tablemend.operators import (
    Target,
    broken_keys,
    contains_key,
    enforce,
    left_join,
    mark_key,
    orphans,
    reduce_to_deepest,
    with_key_in,
    with_key_not_in,
)
from pyspark.sql.types import IntegerType, LongType

KEYS = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=KEYS, keys=KEYS)
def test_lookups_by_brute_force(spark, rows, keys):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, k int")
    ks = spark.createDataFrame([(k,) for k in keys], "k int")
    present = {k for k in keys if k is not None}
    inside = [i for i, k in enumerate(rows) if k in present]
    outside = [i for i, k in enumerate(rows) if k not in present]
    assert sorted(r["id"] for r in with_key_in(df, ["k"], ks, ["k"]).collect()) == inside
    assert sorted(r["id"] for r in with_key_not_in(df, ["k"], ks, ["k"]).collect()) == outside
    marked = mark_key(df, "k", ks, "k", "found").orderBy("id").collect()
    assert [r["found"] for r in marked] == [k in present for k in rows]


def test_two_column_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (None, "a"), (2, "a")], "x int, y string")
    ks = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (1, None)], "p int, q string")
    inside = with_key_in(df, ["x", "y"], ks, ["p", "q"]).collect()
    assert [tuple(r) for r in inside] == [(1, "a")]
    assert with_key_not_in(df, ["x", "y"], ks, ["p", "q"]).count() == 4


def test_integer_keys_of_different_width_match(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    ks = spark.createDataFrame([(1,), (2**40,)], "k bigint")
    assert [r["k"] for r in with_key_in(df, ["k"], ks, ["k"]).collect()] == [1]
    assert [r["k"] for r in with_key_not_in(ks, ["k"], df, ["k"]).collect()] == [2**40]


def test_key_types_must_agree(spark):
    with pytest.raises(ContractError, match="key types differ"):
        with_key_in(spark.createDataFrame([], "k int"), ["k"], spark.createDataFrame([], "k string"), ["k"])


def test_self_lookup(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id int, up int")
    assert [r["id"] for r in with_key_in(df, ["up"], df, ["id"]).collect()] == [2]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 1), (2, 5)], "id int, `a.b` int")
    ks = spark.createDataFrame([(1,)], "`x y` int")
    assert [r["id"] for r in with_key_in(df, ["a.b"], ks, ["x y"]).collect()] == [1]
    assert mark_key(df, "a.b", ks, "x y", "in.side").columns == ["id", "a.b", "in.side"]


def test_contains_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    assert contains_key(df, "id", 2)
    assert not contains_key(df, "id", 3)
    assert not contains_key(df, "t", "b")


def _executed_plan(df):
    df.collect()
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue().split("Initial Plan")[0]


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, and a partition counts as skewed early, as it would on large tables."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot_rows(spark):
    """A third of all rows hold key 77, a third hold none; targets are the even keys, thrice each."""
    n = 60_000
    rows = spark.range(0, n, 1, 16).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(77))
        .when(F.col("id") % 3 == 1, F.when(F.col("id") % 2 == 0, F.lit(0)))
        .otherwise((F.col("id") % 1000) + 1)
        .cast("int")
        .alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    targets = spark.range(0, 3000, 1, 8).select(((F.col("id") % 1000) * 2).cast("int").alias("key"))
    return n, rows, targets


SPEC = table(
    "rows",
    [column("id", IntegerType(), key=True), column("k", IntegerType(), references="targets", on_delete=CASCADE)],
    "rows",
)


def _expected_orphans(n):
    def key(i):
        return 77 if i % 3 == 0 else (0 if i % 2 == 0 else None) if i % 3 == 1 else i % 1000 + 1

    return [i for i in range(n) if key(i) and key(i) % 2 == 1]


def test_hot_orphans_are_split(spark, shuffled_joins, hot_rows):
    n, rows, targets = hot_rows
    found = orphans(rows, "k", Target(targets, "key"))
    plan = _executed_plan(found)
    assert "SortMergeJoin(skew=true)" in plan
    assert found.count() == len(_expected_orphans(n))


def test_hot_keys_are_split_when_enforced(spark, shuffled_joins, hot_rows):
    n, rows, targets = hot_rows
    checked = enforce(rows, SPEC, {"targets": Target(targets, "key")})
    assert "skew=true" in _executed_plan(checked.clean)
    assert checked.clean.count() == n - len(_expected_orphans(n))
    assert sorted(r["id"] for r in checked.quarantine.collect()) == _expected_orphans(n)


def test_every_key_of_a_table_is_split(spark, shuffled_joins, hot_rows):
    n, rows, targets = hot_rows
    twice = rows.withColumn("k2", F.when(F.col("id") % 3 == 1, F.lit(88)).otherwise(F.col("id") % 500).cast("int"))
    spec = table(
        "rows",
        [
            column("id", IntegerType(), key=True),
            column("k", IntegerType(), references="targets", on_delete=CASCADE),
            column("k2", IntegerType(), references="targets", on_delete=SET_NULL),
        ],
        "rows",
    )
    clean = enforce(twice, spec, {"targets": Target(targets, "key")}).clean
    assert _executed_plan(clean).count("skew=true") == 2
    assert clean.count() == n - len(_expected_orphans(n))


def test_rows_without_a_key_are_spread(spark, shuffled_joins, hot_rows):
    """No partition of the look-up receives much more than its share of the rows without a key."""
    _, rows, targets = hot_rows
    unset = rows.where("k IS NULL OR k = 0").withColumn("k", F.nullif("k", F.lit(0)))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        kept = with_key_not_in(unset, ["k"], targets, ["key"], spread_by=["id"])
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sum(sizes) == unset.count()
    assert len(sizes) == 8
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_distinct_values_only_are_moved_to_find_broken_keys(spark, shuffled_joins, hot_rows):
    n, rows, targets = hot_rows
    found = {r["k"]: r["rows"] for r in broken_keys(rows, "k", Target(targets, "key")).collect()}
    assert found[77] >= n // 3
    assert sum(found.values()) == len(_expected_orphans(n))


def test_two_pass_with_a_broadcast_list_does_not_shuffle_the_table(spark, hot_rows, tmp_path):
    n, rows, targets = hot_rows
    checked = enforce(rows, SPEC, {"targets": Target(targets, "key")}, work_dir=str(tmp_path))
    plan = _executed_plan(checked.clean)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert checked.clean.count() == n - len(_expected_orphans(n))


def test_two_pass_by_shuffle_splits_hot_keys(spark, shuffled_joins, hot_rows, tmp_path):
    n, rows, targets = hot_rows
    spec = table(
        "rows",
        [column("id", IntegerType(), key=True), column("k", IntegerType(), references="targets", on_delete=SET_NULL)],
        "rows",
    )
    checked = enforce(rows, spec, {"targets": Target(targets, "key")}, work_dir=str(tmp_path))
    assert "skew=true" in _executed_plan(checked.clean)
    nulled = checked.clean.where("k IS NULL").count()
    assert nulled == len(_expected_orphans(n)) + rows.where("k IS NULL").count()


def test_a_hot_dependent_key_is_split(spark, shuffled_joins):
    main = spark.range(0, 1000, 1, 4).select(F.col("id").cast("int").alias("k"), F.lit("m").alias("m"))
    dependent = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("int").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("d"),
    )
    joined = left_join(main, dependent, "k", unique_key=False)
    assert "skew=true" in _executed_plan(joined)
    assert joined.count() == 60_000 + 500
    assert joined.where("d IS NULL").count() == 500


def test_hot_links_are_split(spark, shuffled_joins):
    """A third of all links repeat one pair, a third lead to one node."""
    links = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("int").alias("item"),
        F.when(F.col("id") % 3 < 2, F.lit(50)).otherwise(F.col("id") % 100).cast("int").alias("node"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    tree = spark.range(0, 1000).selectExpr("CAST(id % 100 AS INT) AS n", "CAST(id % 100 AS INT) DIV 10 AS p")
    kept = reduce_to_deepest(links, tree.withColumn("p", F.col("p").cast("int")), "item", "node", "n", "p")
    assert _executed_plan(kept).count("skew=true") == 2
    # Each item has one node, so only a link to a node that is its own parent goes: 0.
    assert kept.count() == links.where("node <> 0").count()


def test_wide_keys(spark):
    """A key column that is not a number has no 0 to mean "not set"."""
    spec = table("t", [column("k", LongType()), column("f", LongType(), references="u", on_delete=CASCADE)], "t")
    df = spark.createDataFrame([(1, 2**40), (2, 2**41), (3, 0), (4, None)], "k bigint, f bigint")
    us = spark.createDataFrame([(2**40,), (2**40,)], "id bigint")
    checked = enforce(df, spec, {"u": Target(us, "id")})
    assert sorted(r["k"] for r in checked.clean.collect()) == [1, 3, 4]
    text = table("t", [column("f", df.schema["k"].dataType, references="u", on_delete=CASCADE)], "t")
    words = spark.createDataFrame([("0",), ("a",), (None,)], "f string")
    known = spark.createDataFrame([("a",)], "id string")
    assert [r["f"] for r in enforce(words, text, {"u": Target(known, "id")}).quarantine.collect()] == ["0"]
