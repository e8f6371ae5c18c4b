"""Reduce links into a tree to the deepest nodes."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.functions.text import named, quoted
from tablemend.operators.keys import all_present, with_key_not_in
from tablemend.sources.files import write_table


class HierarchyError(ValueError):
    """A tree in which a node is its own ancestor."""


def _written(df: DataFrame, work_dir: str) -> DataFrame:
    path = f"{work_dir.rstrip('/')}/run-{uuid4().hex}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pairs(tree: DataFrame, node: str, parent: str) -> DataFrame:
    return (
        tree.where(all_present([node, parent]))
        .selectExpr(f"{quoted(node)} AS __node", f"{quoted(parent)} AS __parent")
        .distinct()
    )


def _without_covered(links: DataFrame, pairs: DataFrame, item: str, node: str) -> DataFrame:
    covered = links.join(pairs, F.expr(f"{quoted(node)} = __node")).selectExpr(f"{quoted(item)} AS __item", "__parent")
    return with_key_not_in(links, [item, node], covered, ["__item", "__parent"], distinct=False)


def reduce_to_deepest(
    links: DataFrame,
    tree: DataFrame,
    item: str,
    node: str,
    tree_node: str,
    tree_parent: str,
    work_dir: str | None = None,
) -> DataFrame:
    """Drop a link (item, X) when the item is also linked to a node whose direct parent is X.

    One level only; rows that repeat a link are all kept. The tree is narrowed
    to its distinct (node, parent) pairs. An anti join is not multiplied by
    repeated pairs, so those to avoid go into it as they are: links and pairs
    cross one exchange each, in the shape that can be split. The links are read
    twice; with ``work_dir`` they are written there first, so that whatever made
    them runs once.
    """
    if work_dir is not None:
        links = _written(links, work_dir)
    return _without_covered(links, _pairs(tree, tree_node, tree_parent), item, node)


def ancestors(tree: DataFrame, node: str, parent: str, work_dir: str) -> DataFrame:
    """All distinct ``(node, ancestor)`` pairs of a tree, or of any graph of parents without a cycle.

    Paths are joined to paths, so every round doubles the length that is covered:
    a tree of depth d takes about log2(d) rounds, each written below ``work_dir``.
    Rows without a node or a parent have no part. A node that is its own ancestor
    raises :class:`HierarchyError`, in the round whose paths are long enough to show it.
    """
    pairs = _written(_pairs(tree, node, parent), work_dir)
    size = -1
    while True:
        loop = pairs.where("__node = __parent").select("__node").head()
        if loop:
            raise HierarchyError(f"{node} {loop[0]!r} is its own ancestor")
        before, size = size, pairs.count()
        if size == before or size == 0:
            return pairs.select(named("__node").alias(node), named("__parent").alias("ancestor"))
        upper = pairs.selectExpr("__node AS __middle", "__parent AS __upper")
        longer = pairs.join(upper, F.expr("__parent = __middle")).selectExpr("__node", "__upper AS __parent")
        pairs = _written(pairs.unionByName(longer).distinct(), work_dir)


def reduce_to_deepest_of_all(
    links: DataFrame,
    tree: DataFrame,
    item: str,
    node: str,
    tree_node: str,
    tree_parent: str,
    work_dir: str,
    closed: bool = False,
) -> DataFrame:
    """Drop a link (item, X) when the item is also linked to any node below X, however deep.

    ``tree`` holds direct parents, whose closure is worked out first, or with
    ``closed`` all ancestors of every node already, as a table of paths does;
    pairs of a node with itself have no part then. Links are written below ``work_dir`` once.
    """
    if closed:
        pairs = _pairs(tree, tree_node, tree_parent).where("__node <> __parent")
    else:
        pairs = ancestors(tree, tree_node, tree_parent, work_dir).toDF("__node", "__parent")
    return _without_covered(_written(links, work_dir), pairs, item, node)
