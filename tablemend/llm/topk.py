"""Exact top-k by inner product as a Voronoi join.

Pivots divide the vectors into cells. A summary of every cell (rows, radius, largest norm, and the few rows that lie
farthest along the pivot) is all that is known of it elsewhere. From the summaries every query gets a score that its
k-th answer reaches at least, and an upper bound of the scores in every cell: ``q.p + |q| * radius``, or ``|q| * norm``
if that is less. Queries form groups around pivots, too. A cell is sent to a group only if the group's bound reaches
the least score that one of its queries needs, and a query meets only cells that its own bound lets in. Cells are cut into
blocks and groups into chunks of bounded size, so neither a crowded cell nor one vector repeated in a third of the rows
makes a large task. Every block gives each query its k best rows; their k best are the answer, always exact.

Sizes: at most ``MAX_PIVOTS`` pivots from ``SAMPLE`` rows, ``HEADS`` rows of every cell, and as many summaries reach the
driver, whatever the size of the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.common import bounded_sample, in_batches, ship, stored

ship(__name__)

SAMPLE = 1024
MAX_PIVOTS = 64
HEADS = 32
QUERY_CHUNK = 2048
BLOCK_ROWS = (256, 16384)
ROUNDS = 5
#: Scores are compared with bounds in floating point; so much (relative) is granted to rounding.
SLACK = 1e-9


def _matrix(values: list[bytes], width: int) -> np.ndarray:
    """Rows of doubles; shorter ones are filled up with zeros."""
    rows = np.zeros((len(values), width))
    for i, value in enumerate(values):
        row = np.frombuffer(value, dtype="<f8")
        rows[i, : len(row)] = row
    return rows


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Centres of ``n`` cells of a sample, by a few rounds of moving each to the mean of its rows."""
    pivots = np.unique(sample, axis=0)[:: max(1, len(sample) // n)][:n]
    for _ in range(ROUNDS):
        cell = _nearest(sample, pivots)
        pivots = np.vstack([sample[cell == j].mean(0) if (cell == j).any() else pivots[j] for j in range(len(pivots))])
    return pivots


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return ((pivots * pivots).sum(1)[None, :] - 2 * rows @ pivots.T).argmin(1)


def scores_of(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products. Doubles hold them exactly as long as they are small; else Python's integers do."""
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if largest < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries) @ whole(rows).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, <key>, score)``: the ``k`` rows with the highest score for every query.

    Components are floor(scale * x). Rows take no part if the key or vector is null, or a component is null or not
    finite. Vectors of different lengths are compared as if filled up with zeros. A row is never an answer to a query of
    its own key. A key that several query rows share is asked once, with the least of its vectors; rows repeated among
    the candidates are candidates each. Scores beyond a long are cut to its range. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    frame = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    frame = frame.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    total = frame.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width"), F.count_if("asks").alias("asks")).first()
    id_type = frame.schema["id"].dataType.simpleString()
    answer = f"query_id {id_type}, rank int, {key} {id_type}, score long"
    if not total["rows"] or not total["asks"]:
        return spark.createDataFrame([], answer)
    width = total["width"]
    block_rows = min(max(total["rows"] // 64, BLOCK_ROWS[0]), BLOCK_ROWS[1])
    n_pivots = min(MAX_PIVOTS, max(4, math.isqrt(total["rows"]) // 16))

    picked = bounded_sample(frame, "id", SAMPLE).select("v").collect()
    sample = np.floor(scale * _matrix([np.array(r[0], dtype="<f8").tobytes() for r in picked], width))
    pivots = choose_pivots(sample, n_pivots)
    placed = stored(_place(frame, pivots, scale, width))

    cells = _summaries(placed, len(pivots))
    heads = _heads(placed, width)
    n_groups = min(len(pivots), max(1, total["asks"] // QUERY_CHUNK))
    queries = stored(_bounds(placed.where("asks"), pivots, cells, heads, n_groups, k, width, id_type))
    pairs = spark.createDataFrame(
        _pairs(queries, pivots, cells, block_rows), "cell int, g int, chunks int, blocks int"
    )
    return _solve(placed, queries, F.broadcast(pairs), k, width, id_type).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score"
    )


def _place(frame: DataFrame, pivots: np.ndarray, scale: float, width: int) -> DataFrame:
    """Scaled vectors with their cell, their distance from its pivot and their length along it."""

    def run(batch):
        rows = np.zeros((batch.num_rows, width))
        for i, v in enumerate(batch.column(1)):
            values = np.asarray(v.as_py(), dtype=float)
            rows[i, : len(values)] = np.floor(scale * values)
        cell = _nearest(rows, pivots)
        own = pivots[cell]
        return {
            "id": batch.column(0),
            "asks": batch.column(2),
            "v": pa.array([r.tobytes() for r in rows], pa.binary()),
            "cell": cell.astype(np.int32),
            "radius": np.sqrt(((rows - own) ** 2).sum(1)),
            "norm": np.sqrt((rows * rows).sum(1)),
            "along": (rows * own).sum(1),
        }

    kind = frame.schema["id"].dataType.simpleString()
    schema = f"id {kind}, asks boolean, v binary, cell int, radius double, norm double, along double"
    return in_batches(frame, run, schema)


def _summaries(placed: DataFrame, n: int) -> dict[str, np.ndarray]:
    """Rows, radius and largest norm of every cell."""
    found = {name: np.zeros(n) for name in ("rows", "radius", "norm")}
    for r in placed.groupBy("cell").agg(F.count("*"), F.max("radius"), F.max("norm")).collect():
        for name, value in zip(found, r[1:]):
            found[name][r[0]] = value
    return found


def _heads(placed: DataFrame, width: int) -> tuple[list, np.ndarray]:
    """The rows of every cell that lie farthest along its pivot: real candidates that any query can be scored against."""
    order = Window.partitionBy("cell").orderBy(F.desc("along"), "id")
    rows = placed.withColumn("n", F.row_number().over(order)).where(F.col("n") <= HEADS).select("id", "v").collect()
    return [r[0] for r in rows], _matrix([bytes(r[1]) for r in rows], width)


def _bounds(asking, pivots, cells, heads, n_groups, k, width, id_type) -> DataFrame:
    """Every query with its group, the score its k-th answer reaches at least, and the cells that may reach it."""
    head_ids, head_rows = heads
    ids = np.array(head_ids, dtype=object)
    norms = np.sqrt((pivots * pivots).sum(1))

    def run(batch):
        rows = _matrix([v.as_py() for v in batch.column(1)], width)
        norm = np.sqrt((rows * rows).sum(1))
        known = (rows @ head_rows.T).astype(float)
        known[np.array(batch.column(0).to_pylist(), dtype=object)[:, None] == ids[None, :]] = -np.inf
        floor = np.partition(known, -k, axis=1)[:, -k] if known.shape[1] >= k else np.full(len(rows), -np.inf)
        reach = np.minimum(rows @ pivots.T + norm[:, None] * cells["radius"], norm[:, None] * cells["norm"])
        spare = SLACK * (1 + norm[:, None] * (norms + cells["radius"] + cells["norm"]))
        open_cells = (reach + spare >= floor[:, None]) & (cells["rows"] > 0)
        group = _nearest(rows, pivots[:n_groups])
        return {
            "id": batch.column(0),
            "v": batch.column(1),
            "g": group.astype(np.int32),
            "away": np.sqrt(((rows - pivots[group]) ** 2).sum(1)),
            "norm": norm,
            "floor": floor,
            "cells": [np.flatnonzero(o).tolist() for o in open_cells],
        }

    frame = asking.groupBy("id").agg(F.min("v").alias("v"))
    return in_batches(
        frame, run, f"id {id_type}, v binary, g int, away double, norm double, floor double, cells array<int>"
    )


def _pairs(queries: DataFrame, pivots: np.ndarray, cells: dict, block_rows: int) -> list[tuple]:
    """``(cell, group, chunks, blocks)`` for every cell that a group's bound lets in: at most ``MAX_PIVOTS`` squared rows."""
    out = []
    norms = np.sqrt((pivots * pivots).sum(1))
    sums = queries.groupBy("g").agg(F.count("*"), F.max("away"), F.max("norm"), F.min("floor")).collect()
    for g, n, away, norm, floor in sums:
        reach = np.minimum(pivots @ pivots[g] + away * norms + norm * cells["radius"], norm * cells["norm"])
        spare = SLACK * (1 + norm * (norms + cells["radius"] + cells["norm"]))
        for j in np.flatnonzero((reach + spare >= floor) & (cells["rows"] > 0)):
            out.append((int(j), g, -(-n // QUERY_CHUNK), int(-(-cells["rows"][j] // block_rows))))
    return out


def _solve(placed, queries, pairs, k, width, id_type) -> DataFrame:
    at = ["g", "chunk", "cell", "block"]
    rows = (
        placed.join(pairs, "cell")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(*_keys(F.pmod(F.xxhash64("id", "v"), "blocks")), "id", "v")
        .toDF(*(f"to_{name}" for name in at), "id", "v")
    )
    asked = (
        queries.select("id", "v", "g", F.explode("cells").alias("cell"))
        .join(pairs, ["g", "cell"])
        .withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*_keys(F.col("block")), "id", "v")
    )

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "id": [], "score": []}
        if left.num_rows and right.num_rows:
            ids, data = right.column("id").to_numpy(), _matrix(right.column("v").to_pylist(), width)
            askers, wanted = left.column("id").to_numpy(), _matrix(left.column("v").to_pylist(), width)
            for start in range(0, len(askers), 256):
                for name, line in zip(askers[start : start + 256], scores_of(wanted[start : start + 256], data)):
                    others = np.flatnonzero(ids != name)
                    best = others[best_of(line[others], ids[others], k)]
                    found["query_id"] += [name] * len(best)
                    found["id"] += ids[best].tolist()
                    found["score"] += line[best].tolist()
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(found.items(), (id_arrow, id_arrow, pa.int64()))})

    id_arrow = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    local = (
        asked.groupBy(*at).cogroup(rows.groupBy(*(f"to_{name}" for name in at))).applyInArrow(solve, f"query_id {id_type}, id {id_type}, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _keys(block: Column) -> list[Column]:
    return [F.col("g"), F.col("chunk"), F.col("cell"), block.cast("int").alias("block")]
