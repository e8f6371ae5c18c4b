"""Duplicates, foreign keys, joins, hierarchy, projections and quality on small tables, by brute force."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DecimalType, IntegerType, StringType

from tablemend import CASCADE, DO_NOTHING, SET_NULL, Catalog, ContractError, JoinInto, column, table
from tablemend.operators import (
    DedupRule,
    Target,
    declared_columns,
    deduplicate,
    deduplicate_all,
    distinct_texts,
    distinct_values,
    enforce,
    fill_defaults,
    join_all,
    left_join,
    mark_key,
    normalize_lenient,
    orphan_counts,
    profile,
    project_all,
    project_to_target,
    reduce_to_deepest,
    rejects,
    repeated_keys,
    rows_with_keys,
    sweep,
    target_columns,
    violations,
    without_columns,
)

INT, TEXT = IntegerType(), StringType()
SMALL = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
MAYBE = st.one_of(st.none(), st.integers(0, 3))


def _tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- duplicates -------------------------------------------------------------


@SMALL
@given(rows=st.lists(st.tuples(MAYBE, MAYBE), max_size=10))
def test_deduplicate_by_brute_force(spark, rows):
    numbered = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "id int, a int, b int")
    groups = {}
    for row in numbered:
        groups.setdefault(row[1:], []).append(row)
    assert _tuples(deduplicate(df, ["a", "b"], "first", ["id"])) == sorted((g[0] for g in groups.values()), key=repr)
    assert _tuples(deduplicate(df, ["a", "b"], "last", ["id"])) == sorted((g[-1] for g in groups.values()), key=repr)
    alone = [g[0] for g in groups.values() if len(g) == 1]
    assert _tuples(deduplicate(df, ["a", "b"], "none")) == sorted(alone, key=repr)
    kept = _tuples(deduplicate(df, ["a", "b"], "any"))
    assert len(kept) == len(groups) and set(kept) <= set(numbered)


def test_deduplicate_keeps_columns_and_is_idempotent(spark):
    rows = [("x", 2, 1.0), ("x", 1, 2.0), (None, 3, 3.0), (None, 4, 4.0)]
    df = spark.createDataFrame(rows, "t string, id int, v double")
    for keep in ("first", "last", "any", "none"):
        once = deduplicate(df, ["t"], keep, ["id"])
        assert once.columns == df.columns
        assert _tuples(deduplicate(once, ["t"], keep, ["id"])) == _tuples(once)
    assert _tuples(deduplicate(df.select("t"), ["t"], "none")) == []


def test_deduplicate_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, t string")
    for keep in ("first", "last", "any", "none"):
        assert deduplicate(df, ["t"], keep, ["id"]).count() == 0


def test_deduplicate_rejects_what_it_cannot_decide(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="needs order_by"):
        deduplicate(df, ["id"], "first")
    with pytest.raises(ValueError, match="must be first"):
        deduplicate(df, ["id"], "most")


def test_deduplicate_groups_shrink_before_the_shuffle(spark):
    import contextlib
    import io

    df = spark.range(10).selectExpr("id", "id % 2 AS g", "'x' AS t")
    plans = {}
    for keep in ("first", "any", "none"):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            deduplicate(df, ["g"], keep, ["id"]).explain()
        plans[keep] = out.getvalue()
    assert "row_number(), 1, Partial" in plans["first"] and "row_number(), 1, Partial" in plans["any"]
    assert "partial_count" in plans["none"] and not any("SortAggregate" in p for p in plans.values())


def test_deduplicate_any_keeps_whole_rows(spark):
    rows = [(i, i % 4 if i % 5 else None, f"p{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, g int, p string").repartition(5)
    kept = [tuple(r) for r in deduplicate(df, ["g"], "any").collect()]
    assert set(kept) <= set(rows) and sorted(map(repr, (r[1] for r in kept))) == ["0", "1", "2", "3", "None"]


def test_deduplicate_all_uses_the_key_as_order(spark):
    spec = table("r", [column("id", INT, key=True), column("t", TEXT)], "r")
    df = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "id int, t string")
    out = deduplicate_all(Catalog([spec]), {"r": df}, {"r": DedupRule(("t",)), "absent": DedupRule(("x",))})
    assert _tuples(out["r"]) == [(1, "a"), (3, "b")]


def test_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (" ",), (" a",)], "t string")
    assert _tuples(distinct_values(df, "t")) == sorted([("a",), (None,), (" ",), (" a",)], key=repr)
    assert _tuples(distinct_texts(df, "t")) == [(" a",), ("a",)]


# --- foreign keys -----------------------------------------------------------


def _spec(policy_p, policy_s):
    return table(
        "line",
        [
            column("id", INT, key=True),
            column("p", INT, references="part", on_delete=policy_p),
            column("s", INT, references="shop", on_delete=policy_s),
        ],
        "line",
    )


@pytest.mark.parametrize("two_pass", [False, True])
@pytest.mark.parametrize("policies", [(CASCADE, SET_NULL), (SET_NULL, CASCADE), (DO_NOTHING, CASCADE)])
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(MAYBE, MAYBE), max_size=10),
    parts=st.lists(MAYBE, max_size=4),
    shops=st.lists(MAYBE, max_size=4),
)
def test_enforce_by_brute_force(spark, tmp_path_factory, policies, two_pass, rows, parts, shops):
    numbered = [(i, p, s) for i, (p, s) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "id int, p int, s int")
    targets = {
        "part": Target(spark.createDataFrame([(k,) for k in parts], "k int"), "k"),
        "shop": Target(spark.createDataFrame([(k,) for k in shops], "k int"), "k"),
    }
    clean, quarantine = [], []
    for i, p, s in numbered:
        row, dropped = [i, p, s], False
        for position, policy, known, name in ((1, policies[0], parts, "p"), (2, policies[1], shops, "s")):
            value = (i, p, s)[position]
            if not value or value in known:
                continue
            quarantine.append((i, p, s, "line", name, {"p": "part", "s": "shop"}[name], policy))
            if policy == CASCADE:
                dropped = True
            elif policy == SET_NULL:
                row[position] = None
        if not dropped:
            clean.append(tuple(row))
    work_dir = str(tmp_path_factory.mktemp("keys")) if two_pass else None
    checked = enforce(df, _spec(*policies), targets, work_dir=work_dir)
    assert checked.clean.columns == df.columns
    assert _tuples(checked.clean) == sorted(clean, key=repr)
    assert checked.quarantine.columns == [*df.columns, "_table", "_fk", "_target", "_policy"]
    assert _tuples(checked.quarantine) == sorted(quarantine, key=repr)


def test_enforce_is_idempotent_and_splits_the_input(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 9, 1), (3, None, 9), (4, 0, 1)], "id int, p int, s int")
    known = {n: Target(spark.createDataFrame([(1,), (1,), (0,)], "k int"), "k") for n in ("part", "shop")}
    spec = _spec(CASCADE, CASCADE)
    checked = enforce(df, spec, known)
    assert _tuples(checked.clean.unionByName(checked.quarantine.select(df.columns))) == _tuples(df)
    again = enforce(checked.clean, spec, known)
    assert _tuples(again.clean) == _tuples(checked.clean) and again.quarantine.count() == 0
    for policy in (SET_NULL, DO_NOTHING):
        assert enforce(df, _spec(policy, policy), known).clean.count() == 4


def test_zero_as_null(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 9, 1)], "id int, p int, s int")
    known = {n: Target(spark.createDataFrame([(1,)], "k int"), "k") for n in ("part", "shop")}
    checked = enforce(df, _spec(SET_NULL, DO_NOTHING), known, zero_as_null=True)
    assert _tuples(checked.clean) == [(1, None, None), (2, None, 1)]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, 5, None)], "id int, p int, s int")
    none = Target(spark.createDataFrame([], "k int"), "k")
    checked = enforce(df, _spec(CASCADE, SET_NULL), {"part": none, "shop": none})
    assert checked.clean.count() == 0 and checked.quarantine.count() == 1
    checked = enforce(df.where("false"), _spec(CASCADE, SET_NULL), {"part": none, "shop": none})
    assert checked.clean.count() == 0 and checked.quarantine.count() == 0


CHAIN = Catalog(
    [
        table("a", [column("id", INT, key=True)], "a"),
        table("b", [column("id", INT, key=True), column("a", INT, references="a", on_delete=CASCADE)], "b"),
        table("c", [column("id", INT, key=True), column("b", INT, references="b", on_delete=CASCADE)], "c"),
    ]
)


def test_sweep_uses_the_tables_as_given_unless_transitive(spark):
    tables = {
        "c": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, b int"),
        "b": spark.createDataFrame([(1, 1), (2, 9)], "id int, a int"),
        "a": spark.createDataFrame([(1,)], "id int"),
    }
    clean, quarantine = sweep(CHAIN, tables)
    assert _tuples(clean["b"]) == [(1, 1)]
    assert _tuples(clean["c"]) == [(1, 1), (2, 2)]
    assert _tuples(orphan_counts(quarantine)) == [("b", "a", 1), ("c", "b", 1)]
    clean, quarantine = sweep(CHAIN, tables, transitive=True)
    assert _tuples(clean["c"]) == [(1, 1)]
    assert _tuples(orphan_counts(quarantine)) == [("b", "a", 1), ("c", "b", 2)]


def test_every_broken_key_is_reported_whatever_the_order(spark):
    rows = spark.createDataFrame([(1, 9, 9), (2, 1, 9), (3, 9, 1), (4, 1, 1), (5, None, 0)], "id int, p int, s int")
    known = {n: Target(spark.createDataFrame([(1,)], "k int"), "k") for n in ("part", "shop")}
    spec = _spec(CASCADE, SET_NULL)
    swapped = table("line", [spec.schema[0], spec.schema[2], spec.schema[1]], "line")
    found = [_tuples(enforce(rows, s, known).quarantine) for s in (spec, swapped)]
    assert found[0] == found[1] and [(r[0], r[4]) for r in found[0]] == [(1, "p"), (1, "s"), (2, "s"), (3, "p")]


def test_odd_names_and_types_take_part(spark):
    spec = table("o'brien", [column("it's", INT, references="u'v", on_delete=CASCADE)], "t")
    df = spark.createDataFrame([(1, {"m": 1}, ({"m": 2},)), (None, None, None)], "`it's` int, m map<string,int>, s struct<m:map<string,int>>")
    known = Target(spark.createDataFrame([(2,)], "k int"), "k")
    checked = enforce(df, spec, {"u'v": known})
    assert [tuple(r)[3:] for r in checked.quarantine.collect()] == [("o'brien", "it's", "u'v", CASCADE)]
    assert checked.clean.count() == 1
    assert mark_key(df, "it's", known.rows, "k", "found").where("found").count() == 0


def test_counts_read_only_the_keys(spark, tmp_path):
    from checks.queries import fk_orphan_counts

    plan = fk_orphan_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan
    assert "l_orderkey" not in plan


def test_a_table_that_refers_to_itself_is_swept_to_the_end(spark, tmp_path):
    catalog = Catalog([table("t", [column("id", INT, key=True), column("up", INT, references="t", on_delete=CASCADE)], "t")])
    rows = {"t": spark.createDataFrame([(1, 99), (2, 1), (3, 2), (4, None), (5, 4)], "id int, up int")}
    with pytest.raises(ContractError, match="work_dir"):
        sweep(catalog, rows, transitive=True)
    clean, quarantine = sweep(catalog, rows, transitive=True, work_dir=str(tmp_path))
    assert _tuples(clean["t"]) == [(4, None), (5, 4)]
    assert _tuples(quarantine["t"].select("id")) == [(1,), (2,), (3,)]


def test_two_sweeps_share_a_folder(spark, tmp_path):
    tables = {"b": spark.createDataFrame([(1, 1), (2, 9)], "id int, a int"), "a": spark.createDataFrame([(1,)], "id int")}
    first, _ = sweep(CHAIN, tables, work_dir=str(tmp_path))
    second, _ = sweep(CHAIN, {**tables, "a": spark.createDataFrame([(9,)], "id int")}, work_dir=str(tmp_path))
    assert _tuples(first["b"]) == [(1, 1)] and _tuples(second["b"]) == [(2, 9)]


def test_guarded_casts_equal_plain_ones(spark):
    texts = ["1", " 2 ", "+3", "-4", "", " ", "x", "1.5", "1e3", "99999999999", "2147483648", "\t7\n", "\x01" + "8", "9\x7f", "٣",
             "--1", "1L", "0x1", "\u00a05", None, "007", "+", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in ("tinyint", "int", "bigint"):
        spec = table("t", [column("v", df.selectExpr(f"CAST(1 AS {kind}) AS v").schema[0].dataType)], "t")
        got = [r[0] for r in normalize_lenient(df, spec).collect()]
        assert got == [r[0] for r in df.selectExpr(f"try_cast(v AS {kind})").collect()]
        bad = [r["v"] for r in rejects(df, spec).collect()]
        assert bad == [t for t, g in zip(texts, got) if t is not None and g is None]


def test_sweep_skips_keys_without_their_target(spark):
    tables = {"c": spark.createDataFrame([(1, 1)], "id int, b int")}
    clean, quarantine = sweep(CHAIN, tables)
    assert clean["c"] is tables["c"] and len(quarantine) == 0 and orphan_counts(quarantine) is None


def test_rows_with_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, t string")
    keys = spark.createDataFrame([(2,), (2,), (None,), (7,)], "k int")
    assert _tuples(rows_with_keys(df, "id", keys, "k")) == [(2, "b")]


# --- joins ------------------------------------------------------------------


@SMALL
@given(main=st.lists(MAYBE, max_size=6), dependent=st.lists(MAYBE, max_size=6), unique=st.booleans())
def test_left_join_by_brute_force(spark, main, dependent, unique):
    m = spark.createDataFrame(list(enumerate(main)), "id int, k int")
    d = spark.createDataFrame([(k, i) for i, k in enumerate(dependent)], "k int, d int")
    want = []
    for i, k in enumerate(main):
        hits = [j for j, other in enumerate(dependent) if k is not None and k == other]
        want += [(i, k, j) for j in hits] or [(i, k, None)]
    joined = left_join(m, d, "k", unique_key=unique)
    assert joined.columns == ["id", "k", "d"]
    assert _tuples(joined) == sorted(want, key=repr)


@pytest.mark.parametrize("unique", [True, False])
def test_left_join_collisions(spark, unique):
    m = spark.createDataFrame([(1, "m"), (2, "n")], "id int, name string")
    d = spark.createDataFrame([(1, "d", 5)], "id int, name string, n int")
    with pytest.raises(ContractError, match="both sides"):
        left_join(m, d, "id", unique_key=unique)
    first = left_join(m, d, "id", collisions="first", unique_key=unique)
    assert first.columns == ["id", "name", "n"] and _tuples(first) == [(1, "m", 5), (2, "n", None)]
    both = left_join(m, d, "id", collisions="suffix", unique_key=unique)
    assert both.columns == ["id", "name", "name_right", "n"]
    assert _tuples(both) == [(1, "m", "d", 5), (2, "n", None, None)]


JOINS = Catalog(
    [
        table("text", [column("id", INT, key=True), column("t", TEXT)], "t_text", JoinInto("main")),
        table("unit", [column("unit_id", INT, key=True), column("u", TEXT)], "t_unit", JoinInto("main", "unit")),
        table("main", [column("id", INT, key=True), column("unit", INT)], "t_main"),
    ]
)


def _join_tables(spark):
    return {
        "text": spark.createDataFrame([(1, "x"), (1, "y")], "id int, t string"),
        "unit": spark.createDataFrame([(5, "kg")], "unit_id int, u string"),
        "main": spark.createDataFrame([(1, 5), (2, 6)], "id int, unit int"),
    }


def test_join_all(spark):
    out = join_all(JOINS, _join_tables(spark))
    assert list(out) == ["main"]
    assert _tuples(out["main"]) == [(1, 5, "x", "kg"), (1, 5, "y", "kg"), (2, 6, None, None)]


def test_join_all_needs_dependents_but_not_the_main_table(spark):
    tables = _join_tables(spark)
    del tables["unit"]
    with pytest.raises(KeyError, match="unit is to be joined into main"):
        join_all(JOINS, tables)
    del tables["main"]
    assert list(join_all(JOINS, tables)) == ["text"]


# --- projections ------------------------------------------------------------


def test_target_columns():
    main, text, unit = JOINS["main"], JOINS["text"], JOINS["unit"]
    headers = ["id", "unit", "t", "u", "extra"]
    assert target_columns(headers, main, [text, unit]) == {"id": "id", "unit": "unit", "t": "t", "u": "u"}
    assert target_columns(["id", "u"], main, [text, unit]) == {"id": "id", "u": "u"}
    with pytest.raises(ContractError, match="key"):
        target_columns(["unit"], main)


def test_project_to_target(spark):
    spec = table("p", [column("name", TEXT), column("p_id", INT, key=True), column("gone", INT)], "t_p")
    df = spark.createDataFrame([("a", 1, "x")], "name string, p_id int, more string")
    assert project_to_target(df, spec).columns == ["name", "id"]
    assert declared_columns(df, spec.without("gone")).columns == ["name", "p_id"]
    with pytest.raises(ContractError, match="gone"):
        declared_columns(df, spec)
    assert without_columns(df, "more", "language").columns == ["name", "p_id"]


def test_project_all_names_targets(spark):
    out = project_all(JOINS, join_all(JOINS, _join_tables(spark)))
    assert list(out) == ["t_main"]
    assert out["t_main"].columns == ["id", "unit", "t", "u"]


# --- hierarchy --------------------------------------------------------------


def test_reduce_to_deepest_root_child_grandchild(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, None)], "category_id int, parent_id int")
    links = spark.createDataFrame(
        [(10, 1, True), (10, 2, False), (10, 3, False), (11, 1, True), (11, 3, True), (12, 4, None), (12, 4, None)],
        "product_id int, category_id int, main boolean",
    )
    kept = reduce_to_deepest(links, tree, "product_id", "category_id", "category_id", "parent_id")
    # 11 is linked to 1 and its grandchild only: one level, so both stay.
    assert _tuples(kept) == sorted(
        [(10, 3, False), (11, 1, True), (11, 3, True), (12, 4, None), (12, 4, None)], key=repr
    )


@SMALL
@given(
    links=st.lists(st.tuples(MAYBE, MAYBE), max_size=10),
    tree=st.lists(st.tuples(MAYBE, MAYBE), max_size=6),
)
def test_reduce_to_deepest_by_brute_force(spark, links, tree):
    def covered(e, x):
        return any(
            e is not None and e2 == e and y is not None and n == y and p is not None and p == x
            for e2, y in links
            for n, p in tree
        )

    df = spark.createDataFrame(links, "e int, x int")
    nodes = spark.createDataFrame(tree, "n int, p int")
    want = sorted((row for row in links if not covered(*row)), key=repr)
    assert _tuples(reduce_to_deepest(df, nodes, "e", "x", "n", "p")) == want


# --- quality ----------------------------------------------------------------

LIMITS = table(
    "review",
    [
        column("id", INT, key=True, nullable=False),
        column("author", TEXT, nullable=False, max_length=3),
        column("rating", INT, min_value=1, max_value=5, default=3),
        column("price", DecimalType(5, 2), min_value=0, default="0.50"),
    ],
    "review",
)


def test_violations(spark):
    df = spark.createDataFrame(
        [
            (1, "abc", 5, Decimal("0.00")),
            (2, "abcd", 6, Decimal("-0.01")),
            (3, None, 0, None),
            (4, "жжж", None, None),
        ],
        "id int, author string, rating int, price decimal(5,2)",
    )
    assert _tuples(violations(df, LIMITS)) == sorted(
        [
            (2, "author", "max_length", "abcd"),
            (2, "rating", "range", "6"),
            (2, "price", "range", "-0.01"),
            (3, "author", "not_null", None),
            (3, "rating", "range", "0"),
        ],
        key=repr,
    )
    unlimited = table("u", [column("id", INT, key=True)], "u")
    assert violations(df, unlimited).columns == ["id", "column_name", "check_name", "value"]
    assert violations(df, unlimited).count() == 0


def test_fill_defaults(spark):
    df = spark.createDataFrame([(1, None, None, None)], "id int, author string, rating int, price decimal(5,2)")
    assert _tuples(fill_defaults(df, LIMITS)) == [(1, None, 3, Decimal("0.50"))]


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert _tuples(repeated_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]


def test_profile(spark):
    df = spark.createDataFrame([(2, "b", None), (1, None, dt.date(2026, 1, 2))], "id int, t string, d date")
    spec = table("x", [column("id", INT, key=True)], "x")
    rows = profile(df, spec).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [
        ("x", 0, "id", "int", 3, 2, 0, "1"),
        ("x", 1, "t", "string", 3, 2, 1, None),
        ("x", 2, "d", "date", 3, 2, 1, "2026-01-02"),
    ]
    empty = profile(df.where("false"), spec).collect()
    assert [(r["n_rows"], r["n_null"], r["first_value"]) for r in empty] == [(0, 0, None)] * 3
    keyless = table("x", [column("t", TEXT), column("id", INT)], "x")
    assert profile(df.select("t", "id"), keyless).count() == 2
