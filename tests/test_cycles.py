"""Contracts in a cycle, hierarchies of several levels, duplicates by digest, references in HTML."""

import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from checks import queries
from tablemend import CASCADE, DO_NOTHING, SET_NULL, Catalog, column, table
from tablemend.contract import ContractError
from tablemend.functions.entities import unescape
from tablemend.operators import (
    DedupRule,
    HierarchyError,
    Target,
    all_broken_keys,
    ancestors,
    deduplicate,
    deduplicate_all,
    reduce_to_deepest,
    reduce_to_deepest_of_all,
    sweep,
)
from tablemend.operators.keys import coded, decoded
from tablemend.plans import ReduceRule, clean
from tablemend.sources.jdbc import load_tables

INT, TEXT = IntegerType(), StringType()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- cycles -------------------------------------------------------------------


def _catalog(references):
    """Tables with an ``id`` and a column for each ``(target, policy)``."""
    return Catalog(
        table(
            name,
            [column("id", INT, key=True)] + [column(f"r{i}", INT, references=t, on_delete=p) for i, (t, p) in enumerate(refs)],
            target=name,
        )
        for name, refs in references.items()
    )


def _brute(references, rows):
    """Clean rows by applying every policy until nothing changes."""
    left = {n: list(r) for n, r in rows.items()}
    while True:
        before = {n: len(r) for n, r in left.items()}
        for name, refs in references.items():
            keys = {t: {r[0] for r in left[t]} for t, _ in refs}
            left[name] = [
                r for r in left[name]
                if not any(p == CASCADE and v not in (None, 0) and v not in keys[t] for (t, p), v in zip(refs, r[1:]))
            ]
        if before == {n: len(r) for n, r in left.items()}:
            break
    out = {}
    for name, refs in references.items():
        keys = {t: {r[0] for r in left[t]} for t, _ in refs}
        out[name] = [
            (r[0], *(None if p == SET_NULL and v not in (None, 0) and v not in keys[t] else v for (t, p), v in zip(refs, r[1:])))
            for r in left[name]
        ]
    return out


def _sweep(spark, references, rows, folder):
    tables = {
        n: spark.createDataFrame(r, ", ".join(["id int", *(f"r{i} int" for i in range(len(references[n])))]))
        for n, r in rows.items()
    }
    clean_tables, quarantine = sweep(_catalog(references), tables, transitive=True, work_dir=folder)
    return {n: [tuple(r) for r in df.collect()] for n, df in clean_tables.items()}, quarantine


def _order(rows):
    return sorted(rows, key=lambda r: [(v is not None, v or 0) for v in r])


GRAPHS = {
    "two": {"a": [("b", CASCADE)], "b": [("a", CASCADE)]},
    "three": {"a": [("b", CASCADE)], "b": [("c", CASCADE)], "c": [("a", CASCADE)]},
    "mixed": {"a": [("b", CASCADE), ("c", SET_NULL)], "b": [("a", CASCADE), ("out", CASCADE)], "c": [("a", CASCADE), ("c", CASCADE)], "out": []},
    "nulled": {"a": [("b", SET_NULL)], "b": [("a", CASCADE), ("out", CASCADE)], "out": []},
    "only_nulled": {"a": [("b", SET_NULL)], "b": [("a", SET_NULL), ("out", CASCADE)], "out": []},
    "itself_nulled": {"a": [("a", SET_NULL), ("out", CASCADE)], "out": []},
    "before_and_after": {"end": [("a", CASCADE)], "a": [("b", CASCADE), ("first", CASCADE)], "b": [("a", CASCADE)], "first": [("out", CASCADE)], "out": []},
}


@pytest.mark.parametrize("graph", sorted(GRAPHS))
def test_a_cycle_is_swept_to_the_end(spark, tmp_path, graph):
    references, pick = GRAPHS[graph], random.Random(graph)
    rows = {n: [(i, *(pick.choice([None, 0, *range(1, 24), 99]) for _ in refs)) for i in range(1, 22)] for n, refs in references.items()}
    # Keys may repeat: one is left while any row of it is.
    rows = {n: r + r[:2] + [(r[3][0], *([None] * len(references[n])))] for n, r in rows.items()}
    got, _ = _sweep(spark, references, rows, str(tmp_path))
    want = _brute(references, rows)
    assert {n: _order(r) for n, r in got.items()} == {n: _order(r) for n, r in want.items()}


def test_a_long_chain_through_two_tables_falls(spark, tmp_path):
    references = GRAPHS["two"]
    rows = {"a": [(i, i) for i in range(1, 13)] + [(50, 50)], "b": [(i, i + 1) for i in range(1, 13)] + [(50, 50)]}
    got, quarantine = _sweep(spark, references, rows, str(tmp_path))
    assert got == {"a": [(50, 50)], "b": [(50, 50)]}
    assert quarantine["a"].count() == quarantine["b"].count() == 12


def _joined_lists(monkeypatch, most):
    """Every list of keys that the rounds of a sweep join to: its rows, and whether it must not be broadcast."""
    from tablemend.operators import integrity

    seen = []

    def watched(look_up):
        def call(df, columns, keys, *args, **more):
            if columns[0] == "key" or columns[0].startswith("ref_"):
                seen.append((keys.count(), "strategy=merge" in keys._jdf.queryExecution().analyzed().toString()))
            return look_up(df, columns, keys, *args, **more)

        return call

    for name in ("with_key_in", "with_key_not_in"):
        monkeypatch.setattr(integrity, name, watched(getattr(integrity, name)))
    monkeypatch.setattr(integrity, "BROADCAST_ROWS", most, raising=False)
    return seen


#: A chain of four keys in each table, beside 60 rows of ``a`` that refer to nothing as given and 30 that stay.
CHAIN = {"a": [(i, i) for i in range(1, 5)] + [(i, 9999) for i in range(100, 160)] + [(i, 50) for i in range(200, 230)], "b": [(i, i + 1) for i in range(1, 5)] + [(50, 200)]}


def test_a_round_does_not_move_what_fell_before_it(spark, tmp_path, monkeypatch):
    seen = _joined_lists(monkeypatch, 1000)
    got, _ = _sweep(spark, GRAPHS["two"], CHAIN, str(tmp_path))
    assert got == {"a": CHAIN["a"][64:], "b": [(50, 200)]}
    # The list of the first 60 is joined once when they fell and once at the end; what is left of a table, once.
    assert sum(1 for rows, _ in seen if rows > 10) <= 4 and sum(rows for rows, _ in seen) < 300


def test_long_lists_are_not_broadcast_in_the_rounds(spark, tmp_path, monkeypatch):
    seen = _joined_lists(monkeypatch, 3)
    got, _ = _sweep(spark, GRAPHS["two"], CHAIN, str(tmp_path))
    assert got == {"a": CHAIN["a"][64:], "b": [(50, 200)]}
    assert {by_shuffle for rows, by_shuffle in seen if rows > 3} == {True}


def test_the_quarantine_of_a_cycle_takes_short_lists_only(spark, tmp_path, monkeypatch):
    # Customers from 30 on get other keys, so orders from 30 on fall, of which 30 and 60 bring down customers 3 and 6.
    # There are no orders from 90 on, to which every third customer from 9 on refers.
    spark.range(90).selectExpr("id AS c_custkey", "IF(id < 30, 1.0D, -1.0D) AS c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(90).selectExpr("id AS o_orderkey", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    seen = _joined_lists(monkeypatch, 10)
    got = queries.fk_cascade_cycle_quarantine(spark, str(tmp_path)).collect()
    below = [(k, 10 * k, "c_orderkey", "orders") for k in range(3, 30, 3)]
    moved = [(-1 - k, 10 * k, "c_orderkey", "orders") for k in range(30, 90, 3)]
    assert sorted(map(tuple, got)) == sorted(below + moved)
    assert {by_shuffle for rows, by_shuffle in seen if rows > 10} == {True}


@pytest.mark.parametrize("graph", ["three", "mixed", "nulled"])
def test_a_cycle_is_swept_by_shuffles(spark, tmp_path, monkeypatch, graph):
    from tablemend.operators import integrity

    monkeypatch.setattr(integrity, "BROADCAST_ROWS", 1, raising=False)
    test_a_cycle_is_swept_to_the_end(spark, tmp_path, graph)


def test_cycles_need_a_folder(spark):
    rows = {"a": [(1, 1)], "b": [(1, 1)]}
    with pytest.raises(ContractError, match="work_dir"):
        _sweep(spark, GRAPHS["two"], rows, None)


def test_groups_come_after_what_they_refer_to():
    catalog = _catalog(GRAPHS["before_and_after"])
    groups = catalog.load_groups()
    assert groups[0] == ["out"] and ["a", "b"] in groups and groups[-1] == ["end"]
    assert groups.index(["first"]) < groups.index(["a", "b"])
    assert catalog.load_groups(["a", "end"]) == [["a"], ["end"]]
    with pytest.raises(ContractError, match="cycle: a -> b -> a"):
        catalog.load_order()


def test_tables_in_a_cycle_are_loaded_together_if_asked(spark):
    catalog = _catalog(GRAPHS["two"])
    tables = {n: spark.createDataFrame([(1, 1)], "id int, r0 int") for n in "ba"}
    seen = []
    with pytest.raises(ContractError, match="cycle"):
        load_tables(catalog, tables, lambda df, name: seen.append(name))
    assert seen == []
    assert load_tables(catalog, tables, lambda df, name: seen.append(name), deferred=True) == seen == ["a", "b"]


# --- all keys of a table at once --------------------------------------------


def test_values_of_every_type_are_told_apart(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'a', DATE'2020-01-01', 1.50BD, -0.0D, X'00FF', TIMESTAMP'2020-01-01 00:00:00', true), "
        "(2, '', DATE'1900-02-28', -3.00BD, 2.5D, X'', TIMESTAMP'1969-12-31 23:59:59.999999', false) AS t(i, s, d, n, f, b, t, z)"
    )
    for name in df.columns:
        kind = df.schema[name].dataType
        whole, text = coded(name, kind)
        back = df.selectExpr(name, f"{whole} AS whole", f"{text} AS text").selectExpr(name, f"{decoded('whole', 'text', kind)} AS back")
        assert back.schema["back"].dataType == kind
        assert all(r[0] == r[1] for r in back.collect()) and back.distinct().count() == 2


def test_broken_keys_of_several_types_at_once(spark):
    spec = table(
        "line",
        [column("p", INT, references="part", on_delete=CASCADE), column("s", TEXT, references="shop", on_delete=SET_NULL),
         column("q", INT, references="part", on_delete=DO_NOTHING)],
        target="line",
    )
    df = spark.createDataFrame([(1, "x", 2), (1, "y", 3), (9, "", 0), (9, None, 9), (None, "1", 1)], "p int, s string, q int")
    targets = {
        "part": Target(spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long"), "k"),
        "shop": Target(spark.createDataFrame([("x",), (None,)], "k string"), "k"),
    }
    got = sorted(tuple(r) for r in all_broken_keys(df, spec.foreign_keys, targets).collect())
    assert got == [(0, 9, "", 2), (1, 0, "", 1), (1, 0, "1", 1), (1, 0, "y", 1), (2, 3, "", 1), (2, 9, "", 1)]


def test_two_passes_scan_the_keys_once(spark, tmp_path, monkeypatch):
    from tablemend.operators import integrity

    seen = []
    monkeypatch.setattr(integrity, "_written", lambda df, path: seen.append(_plan(df)) or df)
    tables = queries._line_tables(spark, "/root/testdata/sf0.001")
    sweep(queries.LINE_CATALOG, tables, work_dir=str(tmp_path))
    assert len(seen) == 1 and seen[0].count("lineitem.parquet") == 1


# --- several levels -----------------------------------------------------------

TREE = [(2, 1), (3, 2), (4, 3), (5, 1), (6, 5), (6, 3), (7, None), (None, 1), (2, 1)]
LINKS = [(1, 1), (1, 4), (1, 4), (2, 2), (2, 6), (2, 7), (3, 5), (3, 1), (4, 1), (None, 1), (5, None), (6, 3), (6, 5)]


def _frames(spark):
    return spark.createDataFrame(LINKS, "item int, node int"), spark.createDataFrame(TREE, "node int, parent int")


def test_ancestors_over_all_levels(spark, tmp_path):
    _, tree = _frames(spark)
    got = sorted(tuple(r) for r in ancestors(tree, "node", "parent", str(tmp_path)).collect())
    assert got == [(2, 1), (3, 1), (3, 2), (4, 1), (4, 2), (4, 3), (5, 1), (6, 1), (6, 2), (6, 3), (6, 5)]
    long = spark.range(1, 40).selectExpr("id AS node", "id - 1 AS parent")
    assert ancestors(long, "node", "parent", str(tmp_path)).count() == 39 * 40 // 2
    assert ancestors(tree.where("false"), "node", "parent", str(tmp_path)).count() == 0


@pytest.mark.parametrize("loop", [[(1, 1)], [(1, 2), (2, 3), (3, 1), (9, 3)]])
def test_a_loop_in_a_tree_is_reported(spark, tmp_path, loop):
    tree = spark.createDataFrame(loop, "node int, parent int")
    with pytest.raises(HierarchyError, match="own ancestor"):
        ancestors(tree, "node", "parent", str(tmp_path))


def test_links_are_reduced_over_all_levels(spark, tmp_path):
    links, tree = _frames(spark)
    up = {(2, 1), (3, 1), (3, 2), (4, 1), (4, 2), (4, 3), (5, 1), (6, 1), (6, 2), (6, 3), (6, 5)}
    want = [(i, n) for i, n in LINKS if not any(j == i and (m, n) in up for j, m in LINKS if i is not None)]
    got = reduce_to_deepest_of_all(links, tree, "item", "node", "node", "parent", str(tmp_path))
    assert _order(map(tuple, got.collect())) == _order(want)
    closed = spark.createDataFrame([*up, (1, 1), (4, 4)], "category int, path int")
    got = reduce_to_deepest_of_all(links, closed, "item", "node", "category", "path", str(tmp_path), closed=True)
    assert _order(map(tuple, got.collect())) == _order(want)
    one = _order(map(tuple, reduce_to_deepest(links, tree, "item", "node", "node", "parent").collect()))
    assert one == _order(map(tuple, reduce_to_deepest(links, tree, "item", "node", "node", "parent", str(tmp_path)).collect()))
    assert (1, 1) in one and (1, 1) not in want


def test_levels_as_a_rule_of_the_job(spark, tmp_path):
    links, tree = _frames(spark)
    catalog = Catalog(
        [table("tree", [column("node", INT), column("parent", INT)], "t"), table("links", [column("item", INT), column("node", INT)], "l")]
    )
    rule = {"links": ReduceRule("tree", "item", "node", "node", "parent", levels="all")}
    run = dict(stages=["REDUCE"], reduce_rules=rule)
    with pytest.raises(ValueError, match="work_dir"):
        clean(catalog, {"tree": tree, "links": links}, **run)
    got = clean(catalog, {"tree": tree, "links": links}, **run, work_dir=str(tmp_path)).tables["links"]
    assert (1, 1) not in {tuple(r) for r in got.collect()}


# --- duplicates by digest -------------------------------------------------------

ROWS = [
    (1, "a", 1.0, None), (2, "a", 1.0, None), (3, None, 0.0, "x"), (4, None, -0.0, "x"), (5, "", 0.0, "x"),
    (6, "b", None, "ab"), (7, "ba", None, "b"), (None, "a", 1.0, None), (8, "c", float("nan"), "d"), (9, "c", float("nan"), "d"),
]
SUBSETS = [["t"], ["t", "f", "u"], ["f"], ["u", "t"]]


@pytest.mark.parametrize("keep", ["first", "last", "any", "none"])
@pytest.mark.parametrize("subset", SUBSETS)
def test_by_digest_equals_by_value(spark, tmp_path, keep, subset):
    df = spark.createDataFrame(ROWS, "id int, t string, f double, u string").repartition(3)
    order = ["id"] if keep in ("first", "last") else []
    plain = deduplicate(df, subset, keep, order)
    by_digest = deduplicate(df, subset, keep, order, str(tmp_path))
    assert by_digest.columns == df.columns
    if keep == "any":
        assert by_digest.select(subset).distinct().count() == by_digest.count() == plain.count()
    else:
        assert sorted(map(str, by_digest.collect())) == sorted(map(str, plain.collect()))


def test_ties_leave_one_row(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, "a", 7), (3, "b", 1), (3, "b", 1)], "id int, t string, v int")
    for keep, ids in (("first", [1, 3]), ("last", [2, 3]), ("any", None)):
        got = deduplicate(df, ["t"], keep, ["id"] if ids else [], str(tmp_path)).collect()
        assert sorted(r.t for r in got) == ["a", "b"]
        assert ids is None or sorted(r.id for r in got) == ids


def test_no_text_is_shuffled(spark):
    for query in (queries.dedup_first, queries.dedup_last, queries.dedup_any):
        plan = _plan(query(spark, "/root/testdata/sf0.001"))
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_digest_as_a_rule(spark, tmp_path):
    catalog = Catalog([table("t", [column("id", INT, key=True), column("t", TEXT)], "t")])
    tables = {"t": spark.createDataFrame([(2, "a"), (1, "a")], "id int, t string")}
    rules = {"t": DedupRule(("t",), "first", by_digest=True)}
    with pytest.raises(ValueError, match="work_dir"):
        deduplicate_all(catalog, tables, rules)
    assert [tuple(r) for r in deduplicate_all(catalog, tables, rules, str(tmp_path))["t"].collect()] == [(1, "a")]


# --- HTML references ------------------------------------------------------------


def test_references_equal_the_standard_ones(spark):
    pick = random.Random(3)
    texts = [f"&{n}" for n in html5] + [f"a&{n}b &amp;{n}" for n in html5] + [f"&{n.rstrip(';')}x;" for n in html5]
    edges = [0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 10**30]
    for n in [*range(300), *edges]:
        texts += [f"&#{n};", f"&#{n}z", f"&#x{n:x};", f"&#X{n:X} g", f"&#x0000000000{n:x};", f"&#0000000000{n}"]
    pieces = [*"&&&&##;; xXaAzZ019\t\n\f<>é\U0001f600", "amp", "lt", "notin", "not", "frac12", "AMP", "quot;", "&#x41", "&#65;"]
    texts += ["".join(pick.choice(pieces) for _ in range(pick.randrange(25))) for _ in range(4000)]
    texts += ["", "&", "&&", "&;", "&#;", "&#x;", "&" + "a" * 40 + ";", "&" + "a" * 32 + ";", "&not" + "x" * 40, "&\x00;"]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "i int, t string")
    got = {r.i: r.u for r in df.select("i", unescape(F.col("t")).alias("u")).collect()}
    assert got.pop(len(texts)) is None
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


def test_references_need_no_python(spark):
    plan = _plan(queries.html_unescape(spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "InArrow" not in plan
