"""How filters work together: what each removes in every order they could be applied in.

Every document fails some set of the filters. Documents are counted by that set, so the corpus is read once and all that
follows works on at most 2^n counts for each part of the corpus.

The states of an audit are the sets of filters already applied, an edge of their lattice applies one more. An edge has
the same effect on all orders that take it, so effects are worked out for the n * 2^(n-1) edges, not for n! orders. Two
passes over the lattice count the orders: forwards those that reach a state, backwards those that leave it. Their product
is the number of orders that take an edge; it weights the edge's removals for the Shapley sum. What an order's steps do
is read off its edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.llm.common import stored
from tablemend.operators.keys import mark

#: White space other than the blank, as Java and SQL write it.
_OTHER_WHITE = "\t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_filters(text: str = "text") -> dict[str, Column]:
    """Conditions under which a text that is not null fails: short, repetitive, shouting, full of symbols."""
    value = F.col(text)
    words = F.array_remove(F.split(F.translate(value, _OTHER_WHITE, " " * len(_OTHER_WHITE)), " "), "")
    capitals = F.length(value) - F.length(F.translate(value, _CAPITALS, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 3 * F.length(value).cast("long"),
        "D": value.rlike("[#$%&*|]"),
    }


def failing_counts(
    documents: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column],
    part: Column,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the set of filters they fail.

    Bit i of ``mask`` stands for the i-th of ``filters``, conditions over a column ``text``; the bit after them for a
    text that a row with a smaller key holds as well. Texts are told apart by their SHA-256 digest, so only that
    travels. A null text is empty; a null key is neither smaller nor larger than another. Rows with equal keys and
    texts count each, and none repeats the other. A document is good or toxic if any label row of its key says so.

    No step meets a whole group: copies of a text are folded to one row for each combination of part, mask and labels
    before they meet.
    """
    flags = [F.when(F.coalesce(condition, F.lit(False)), F.lit(1 << i)).otherwise(0) for i, condition in enumerate(filters.values())]
    mask = flags[0]
    for flag in flags[1:]:
        mask = mask + flag
    rows = (
        documents.select(F.col(f"`{key}`").alias("key"), part.alias("part"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
        .select("key", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), mask.alias("mask"))
    )
    for label, column in (("good", "quality"), ("toxic", "toxic")):
        keys = labels.where(F.col(column) == 1).select(F.col("doc_id").alias("label_key"))
        rows = mark(rows, "key", "key", keys, "label_key", label)
    same = ["digest", "part", "mask", "good", "toxic"]
    by_text = stored(
        rows.groupBy(*same, "key")
        .agg(F.count("*").alias("n"))
        .groupBy(*same)
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(F.col("key").isNotNull(), F.struct("key", "n"))).alias("first"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("without_key"),
        )
    )
    least = by_text.groupBy("digest").agg(F.min("first.key").alias("least"))
    first = F.col("without_key") + F.when(F.col("first.key") == F.col("least"), F.col("first.n")).otherwise(0)
    states = F.array(
        F.struct(F.col("mask"), F.col("firsts").alias("n")),
        F.struct((F.col("mask") + (1 << len(flags))).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")),
    )
    return (
        by_text.join(least, "digest")
        .withColumn("firsts", first)
        .select("part", "good", "toxic", F.inline(states))
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For every state, a set of ``n`` filters as a number: orders of its filters that reach it, and orders of the rest."""
    states, bits = range(1 << n), [1 << i for i in range(n)]
    forward, backward = [1] * (1 << n), [1] * (1 << n)
    for state in states[1:]:
        forward[state] = sum(forward[state ^ b] for b in bits if state & b)
    for state in reversed(states[:-1]):
        backward[state] = sum(backward[state | b] for b in bits if not state & b)
    return forward, backward


def _edges(spark: SparkSession, n: int) -> DataFrame:
    """``(before, bit, orders)`` for every edge of the lattice; ``orders`` take it."""
    forward, backward = path_counts(n)
    rows = [
        (state, 1 << i, forward[state] * backward[state | 1 << i])
        for state in range(1 << n)
        for i in range(n)
        if not state & 1 << i
    ]
    return spark.createDataFrame(rows, "before int, bit int, orders long")


def _steps(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``(filter_order, step, before, bit)`` for every step of every order."""
    bit = {name: 1 << i for i, name in enumerate(names)}
    rows = [
        ("".join(order), step + 1, sum(bit[x] for x in order[:step]), bit[order[step]])
        for order in permutations(names)
        for step in range(len(names))
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, before int, bit int")


def audit(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row for every part, order of the filters and step, from ``(part, mask, n, good, toxic)``.

    ``kept`` after the step; ``removed`` by it, of them ``good_lost`` and ``toxic_lost``; ``redundant``: failing its filter but removed
    before; ``unique_fails``: failing no other filter; ``shapley``: what its filter removes, summed over all orders.
    Counts may repeat a mask. The tables of edges, steps and their masks, which are broadcast, depend on the number of
    filters only (80, 600 and 2,560 rows for five). Without counts there is no row.
    """
    spark, n = counts.sparkSession, len(names)
    edges = _edges(spark, n)
    seen = (
        edges.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))).alias("mask"))
        .withColumn("fails", F.col("mask").bitwiseAND(F.col("bit")) != 0)
        .withColumn("gone", F.col("mask").bitwiseAND(F.col("before")) != 0)
    )

    def total(of: str, where: Column, name: str) -> Column:
        return F.sum(F.when(where, F.col(of)).otherwise(0)).alias(name)

    fails, gone = F.col("fails"), F.col("gone")
    effects = (
        counts.join(F.broadcast(seen), "mask")
        .groupBy("part", "before", "bit", "orders")
        .agg(
            total("n", ~fails & ~gone, "kept"),
            total("n", fails & ~gone, "removed"),
            total("n", fails & gone, "redundant"),
            total("n", F.col("mask") == F.col("bit"), "unique_fails"),
            total("good", fails & ~gone, "good_lost"),
            total("toxic", fails & ~gone, "toxic_lost"),
        )
    )
    effects = stored(effects)
    shapley = effects.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    return (
        effects.join(shapley, ["part", "bit"])
        .join(F.broadcast(_steps(spark, names)), ["before", "bit"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
        )
    )


def audit_documents(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The audit of ``text_filters`` and, as ``E``, of repeated texts, for every value of ``part`` (null: empty string).

    An empty or null text is short (A) and fails none of B to D. Texts of any length are taken whole. An empty table
    gives no row. Columns other than the three named take no part, whatever their names.
    """
    filters = text_filters("text")
    value = F.coalesce(F.col(f"`{part}`").cast("string"), F.lit(""))
    return audit(failing_counts(documents, labels, filters, value, key, text), [*filters, "E"])
