"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed.

A seed is the hash of five words within a span of nine; the mask says which. The four masks leave out different places,
so a passage with a few changed words still meets the benchmark in some seed: each 13 words in a row of which at most
three were changed do, wherever the changes are. Every hit names an item and an alignment; there the words are compared
one by one, and the longest stretch is taken of which at least four fifths are equal.

A benchmark of at most ``BLOCK_WORDS`` words goes to the tasks by broadcast, and documents are read once and never shuffled.
A larger one stays where it is: the seeds of both sides become rows, those of documents only where a sieve over the
benchmark's seeds, of bounded size, lets them through. They are joined, and documents and items that have a hit are brought
together to be verified in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import in_batches, numbered, share, ship, stored, texts_of
from tablemend.llm.words import NOT_ALNUM, Words, mixed, runs, words_of

ship(__name__)

SPAN = 9
#: Places within the span that each mask compares.
MASKS = ((0, 2, 6, 7, 8), (0, 2, 3, 4, 8), (0, 1, 5, 6, 8), (0, 1, 2, 7, 8))
MIN_WORDS = 13
BLOCK_WORDS = 500_000
SIEVE_BITS = 22
#: The same for the sieve of a benchmark that is joined; the driver gets as many bits, 2 MB.
JOINED_SIEVE_BITS = 24


def seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The seed at every word that has a whole span after it."""
    size = max(0, len(hashes) - SPAN + 1)
    out = np.full(size, 1 + MASKS.index(mask), dtype=np.uint64)
    for place in mask:
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[place : place + size]
    return mixed(out)


@dataclass(frozen=True)
class Benchmark:
    """Seeds in order, with the item and word where each stands; the words of the items; a sieve over the seeds."""

    items: tuple
    words: Words
    seeds: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    def sieve(self) -> np.ndarray:
        bits = np.zeros(1 << SIEVE_BITS, dtype=bool)
        bits[self.seeds >> np.uint64(64 - SIEVE_BITS)] = True
        return bits


def prepare(items: list, texts: list[str]) -> Benchmark:
    words = words_of([t.lower() for t in texts], NOT_ALNUM, strong=True)
    found, item, offset = [], [], []
    for i in range(len(items)):
        own = words.hashes[words.first[i] : words.first[i + 1]]
        for mask in MASKS:
            s = seeds(own, mask)
            found.append(s)
            item.append(np.full(len(s), i))
            offset.append(np.arange(len(s)))
    found, item, offset = (np.concatenate([*x, np.zeros(0, x[0].dtype if x else np.int64)]) for x in (found, item, offset))
    order = np.argsort(found, kind="stable")
    return Benchmark(tuple(items), words, found[order].astype(np.uint64), item[order], offset[order])


def longest_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The longest range (the first of them) of which at least four fifths are true."""
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    lowest = np.minimum.accumulate(sums)
    begin = np.searchsorted(-lowest, -sums, side="left")
    length = np.arange(len(sums)) - begin
    end = int(length.argmax())
    return int(begin[end]), end


def leaks(texts: list[str], benchmark: Benchmark, sieve: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``(text, item, start, words, equal words)``: the longest stretch of each item in each text, if long enough."""
    words = words_of([t.lower() for t in texts], NOT_ALNUM, strong=True)
    text_of, places = words.text_of(), set()
    whole = np.flatnonzero(text_of[: max(0, len(words) - SPAN + 1)] == text_of[SPAN - 1 :])
    for mask in MASKS:
        s = seeds(words.hashes, mask)
        at = whole[sieve[s[whole] >> np.uint64(64 - SIEVE_BITS)]]
        low, high = np.searchsorted(benchmark.seeds, s[at], "left"), np.searchsorted(benchmark.seeds, s[at], "right")
        count = high - low
        at = np.repeat(at, count)
        entry = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        places |= set(zip(text_of[at].tolist(), benchmark.item[entry].tolist(), (at - benchmark.offset[entry]).tolist()))
    return _verified(words, benchmark.words, places)


def _verified(words: Words, items: Words, places: set[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """The longest stretch of each item in each text, from the places ``(text, item, word where the item would begin)``."""
    best: dict[tuple[int, int], tuple] = {}
    for text, item, begin in sorted(places):
        low, high = items.first[item], items.first[item + 1]
        first, last = max(begin, words.first[text]), min(begin + high - low, words.first[text + 1])
        equal = words.hashes[first:last] == items.hashes[low + first - begin : low + last - begin]
        start, end = longest_stretch(equal)
        if end - start < min(MIN_WORDS, high - low):
            continue
        if end - start < MIN_WORDS and not equal[start:end].all():
            continue
        found = (end - start, -(first + start - words.first[text]), int(equal[start:end].sum()))
        best[text, item] = max(best.get((text, item), (0,)), found)
    return [(t, i, int(-b), int(n), e) for (t, i), (n, b, e) in sorted(best.items())]


def _items(benchmark: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """The distinct items as ``(item, text)``, and about how many words they have."""
    frame = texts_of(benchmark, key, text).toDF("item", "text").distinct()
    return frame, frame.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0


def _sent(items: DataFrame) -> Benchmark:
    """A small benchmark, for the tasks."""
    rows = sorted(items.collect(), key=lambda r: (r[0] is None, r[0], r[1]))
    return prepare([r[0] for r in rows], [r[1] for r in rows])


def _seed_rows(frame: DataFrame, schema: str, sieve: np.ndarray | None = None) -> DataFrame:
    """``(row, seed, at)`` of every text, numbered by the first column; only what passes the sieve."""
    sieve_of = share(frame.sparkSession, sieve)

    def run(batch):
        rows, values, places = [], [], []
        texts, row = batch.column(1).to_pylist(), batch.column(0).to_numpy()
        bits = sieve_of()
        for a, b in runs(texts):
            words = words_of([t.lower() for t in texts[a:b]], NOT_ALNUM, strong=True)
            text_of = words.text_of()
            whole = np.flatnonzero(text_of[: max(0, len(words) - SPAN + 1)] == text_of[SPAN - 1 :])
            for mask in MASKS:
                found = seeds(words.hashes, mask)[whole]
                place = (found >> np.uint64(64 - JOINED_SIEVE_BITS)).astype(np.int64)
                kept = slice(None) if bits is None else (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                rows.append(row[a + text_of[whole][kept]])
                values.append(found[kept].view(np.int64))
                places.append((whole - words.first[text_of[whole]])[kept])
        none = [np.zeros(0, np.int64)]
        return dict(zip(("row", "seed", "at"), (np.concatenate(x or none) for x in (rows, values, places))))

    return in_batches(frame, run, schema)


def _joined(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``(row, item, start_word, n_words, n_equal)`` for documents ``(row, text)`` and a benchmark of any size."""
    numbers = stored(items.select(F.monotonically_increasing_id().alias("i"), "item", "text"))
    seeds_of_items = stored(_seed_rows(numbers.select("i", "text"), "row long, seed long, at long").toDF("i", "seed", "offset"))
    place = F.shiftrightunsigned("seed", 64 - JOINED_SIEVE_BITS)
    octets = seeds_of_items.select(place.alias("p")).selectExpr("shiftright(p, 3) AS byte", "shiftleft(1, CAST(p & 7 AS INT)) AS bit")
    bits = np.zeros(1 << JOINED_SIEVE_BITS - 3, dtype=np.uint8)
    for batch in octets.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        bits[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    hits = _seed_rows(documents.select("row", "text"), "row long, seed long, at long", bits)
    places = (
        hits.join(seeds_of_items, "seed")
        .select("row", "i", (F.col("at") - F.col("offset")).alias("begin"))
        .groupBy("row", "i")
        .agg(F.collect_set("begin").alias("begins"))
    )
    texts = numbers.select("i", "item", F.col("text").alias("item_text"))
    both = stored(places).join(documents.select("row", "text"), "row").join(texts, "i")
    kind = items.schema["item"].dataType.simpleString()

    def run(batch):
        columns: dict[str, list] = {"at": [], "start_word": [], "n_words": [], "n_equal": []}
        for k, (begins, text, item) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("begins", "text", "item_text")))):
            words = words_of([text.lower()], NOT_ALNUM, strong=True)
            own = words_of([item.lower()], NOT_ALNUM, strong=True)
            for _, _, *found in _verified(words, own, {(0, 0, b) for b in begins}):
                for column, value in zip(columns.values(), (k, *found)):
                    column.append(value)
        at = pa.array(columns.pop("at"), pa.int64())
        return {"row": batch.column(0).take(at), "item": batch.column(1).take(at), **columns}

    both = both.select("row", "item", "begins", "text", "item_text")
    return in_batches(both, run, f"row long, item {kind}, start_word int, n_words int, n_equal int")


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(key, item, start_word, n_words, n_equal)``: every benchmark item that a document holds, at its longest stretch.

    Words are runs of letters and digits, in small letters; ASCII punctuation is skipped. A stretch counts from
    ``MIN_WORDS`` words of which four fifths are equal, without shifts. Items of 9 to 12 words must be found whole and
    unchanged; shorter ones prove nothing and take no part. Null and empty texts hold nothing. Repeated documents give
    their rows each, repeated items one. Null keys are keys. An empty benchmark or table gives no rows. Texts of any length
    are taken whole. A benchmark of more than ``block_words`` words is joined instead of sent; the result is the same.
    """
    items, n = _items(benchmark, item_key, item_text)
    types = documents.schema[key].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    if n > block_words:
        frame = numbered(documents, key, text)
        found = frame.select("row", "key").join(_joined(frame, items), "row").drop("row")
        return found.withColumnsRenamed({"key": key, "item": item_key})
    sent = share(documents.sparkSession, _sent(items))

    def run(batch):
        rows = _batch_leaks(batch.column(1).to_pylist(), sent())
        names = sent().items
        return {
            "key": batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
            "item": [names[r[1]] for r in rows],
            "start_word": [r[2] for r in rows],
            "n_words": [r[3] for r in rows],
            "n_equal": [r[4] for r in rows],
        }

    frame = texts_of(documents, key, text).toDF("key", "text")
    found = in_batches(frame, run, f"key {types[0]}, item {types[1]}, start_word int, n_words int, n_equal int")
    return found.withColumnsRenamed({"key": key, "item": item_key})


def _batch_leaks(texts: list[str], benchmark: Benchmark) -> list[tuple]:
    sieve, out = benchmark.sieve(), []
    for a, b in runs(texts):
        out += [(a + t, *rest) for t, *rest in leaks(texts[a:b], benchmark, sieve)]
    return out


def drop_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows, with all their columns, that hold no benchmark item as ``find_leaks`` defines it."""
    items, n = _items(benchmark, item_key, item_text)
    if n > block_words:
        frame = numbered(documents.withColumn("__key", F.lit(None).cast("long")), "__key", text, all_columns=True)
        found = stored(_joined(frame, items).select("row").distinct())
        return frame.join(found, "row", "left_anti").select("columns.*").drop("__key")
    at, names = documents.columns.index(text), documents.columns
    sent = share(documents.sparkSession, _sent(items))

    def run(batch):
        rows = _batch_leaks([t or "" for t in batch.column(at).to_pylist()], sent())
        kept = np.ones(batch.num_rows, dtype=bool)
        kept[[r[0] for r in rows]] = False
        return dict(zip(names, batch.filter(pa.array(kept)).columns))

    return in_batches(documents, run, documents.schema)
