"""Phrases whose words occur together far more often than apart, by partitioned mining in two passes.

First pass: the texts are dealt into shards that fit a task, and every shard is mined completely, for all phrases up to
the longest, at a local support lowered in proportion to its share of the corpus. A phrase that is frequent in the
corpus is locally frequent in at least one shard. The locally frequent phrases of all shards are united, as 64-bit
hashes: each with the most it can occur, which is what the shards that reported it counted and one less than its local
support for every other shard. Those that cannot reach the support are left out. Where local supports are 1, as in many
small shards, that bound is the count itself.

The union becomes a sieve, one bit for each range of hashes, of bounded size. Second pass: every phrase that the sieve
lets through is counted over all texts, by its words, so neither colliding hashes nor a crowded sieve change a result;
they only let phrases be counted that turn out too rare.

Within a shard words are numbered exactly and phrases are numbers made of those, so no step compares strings twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.common import arrow_schema, share, ship, stored
from tablemend.llm.words import SMALL, mixed

ship(__name__)

#: Bytes of text in a shard. A longer text is cut at the ends of its pieces.
SHARD_BYTES = 6_000_000
#: Bytes of text for each bucket that the hashes of the first pass are dealt to.
BUCKET_BYTES = 1 << 23
#: Bits of the sieve: one for so many bytes of text, but at least and at most these powers of two.
BYTES_PER_BIT, LEAST_BITS, MOST_BITS = 8, 20, 28
#: Candidates that one task ranks at a time, about.
RANKED_TOGETHER = 200_000
MARKS = b".,;:!?\n\x0b\x0c\r"
LONG_END = re.compile(r"[.,;:!?\n-\r]")
IS_MARK = np.array([b in MARKS for b in range(256)])
IS_GAP = IS_MARK | np.array([b in b" \t" for b in range(256)])


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts that end where a piece ends; they join to the text."""
    start = 0
    while len(text) - start > SHARD_BYTES:
        end = LONG_END.search(text, start + SHARD_BYTES)
        if not end:
            break
        yield text[start : end.end()]
        start = end.end()
    yield text[start:] if start else text


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """``(lang, texts)``: runs of texts of one language, each ended by a line end, of bounded length."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for part in _pieces(value.as_py()):
                raw = part.encode()
                if size and size + len(raw) > SHARD_BYTES:
                    yield from ((x, b"\n".join([*parts, b""])) for x, parts in held.items())
                    held, size = {}, 0
                held.setdefault(lang, []).append(raw)
                size += len(raw) + 1
    yield from ((x, b"\n".join([*parts, b""])) for x, parts in held.items())


class Shard:
    """The phrases of one shard, exactly: words by number, phrases of ``k`` words by ``k`` columns of numbers, with counts."""

    def __init__(self, lang: str, texts: bytes, longest: int):
        self.lang = lang
        data = SMALL[np.frombuffer(texts, dtype=np.uint8)]
        gap = IS_GAP[data]
        edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
        starts, ends = edge[0::2], edge[1::2]
        self.n_words = len(starts)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), self.n_words, [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])]
        ).dictionary_encode()
        self.words = coded.dictionary
        word = coded.indices.to_numpy().astype(np.int64)
        piece = np.cumsum(IS_MARK[data], dtype=np.int32)[starts]
        v = max(1, len(self.words))
        #: By length of phrase: the numbers of its words, a column each, and how often it occurs.
        self.phrases: list[tuple[list[np.ndarray], np.ndarray]] = []
        counts = np.bincount(word, minlength=len(self.words))
        self.phrases.append(([np.arange(len(self.words))], counts))
        # A phrase is numbered by the number of its first words and that of its last one.
        number, columns = word, [np.arange(len(self.words))]
        for k in range(2, longest + 1):
            last = len(word) - k + 1
            if last <= 0:
                break
            if len(columns[0]) * v >= 1 << 62:
                raise OverflowError("a shard holds too many phrases")  # not with shards of SHARD_BYTES
            number = number[:last] * v + word[k - 1 :]
            inside = piece[:last] == piece[k - 1 :]
            if k < longest:
                found, number, counts = _numbered(number, inside)
            else:
                found, counts = np.unique(number[inside], return_counts=True)
            columns = [c[found // v] for c in columns] + [found % v]
            self.phrases.append((columns, counts))

    def hashes(self) -> list[np.ndarray]:
        """A 64-bit hash of every phrase, by length."""
        seed = xxhash.xxh64_intdigest(self.lang.encode())
        words = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words.to_pylist()], dtype=np.uint64)
        out = []
        for columns, _ in self.phrases:
            h = np.zeros(len(columns[0]), dtype=np.uint64)
            for c in columns:
                h = h * np.uint64(0xD6E8FEB86659FD93) + words[c]
            out.append(mixed(h))
        return out

    def strings(self, columns: list[np.ndarray]) -> pa.Array:
        texts = [self.words.take(pa.array(c)) for c in columns]
        return pc.binary_join_element_wise(*texts, pa.scalar(b" ", pa.large_binary())) if len(texts) > 1 else texts[0]


def _numbered(values: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values that are inside, for every value its place among them (0 if outside), and their counts."""
    found, place, counts = np.unique(values[inside], return_inverse=True, return_counts=True)
    number = np.zeros(len(values), dtype=np.int64)
    number[inside] = place
    return found, number, counts


def _power(n: float) -> int:
    return max(0, int(n) - 1).bit_length()


def _union(texts: DataFrame, total: int, support: int, longest: int, bits: int) -> np.ndarray:
    """The first pass: a sieve of ``2^bits`` bits, set where a hash of a phrase that may be frequent falls."""
    spark = texts.sparkSession
    bucket_bits = min(bits - 6, max(4, _power(total / BUCKET_BYTES)))
    columns = "bucket int, missed long, hashes binary, counts binary"
    target = arrow_schema(spark.createDataFrame([], columns).schema)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _shards(batches):
            shard = Shard(lang, raw, longest)
            local = max(1, -(-support * len(raw) // total))
            hashes = np.concatenate(shard.hashes())
            counts = np.concatenate([c for _, c in shard.phrases])
            often = counts >= local
            hashes, counts = hashes[often], counts[often] - (local - 1)
            order = np.argsort(hashes)
            hashes, counts = hashes[order], np.minimum(counts[order], 1 << 31).astype(np.uint32)
            bucket = (hashes >> np.uint64(64 - bucket_bits)).astype(np.int64)
            ends = np.searchsorted(bucket, np.arange((1 << bucket_bits) + 1))
            sent = np.flatnonzero((np.diff(ends) > 0) | (local > 1))
            rows = {
                "bucket": sent,
                "missed": np.full(len(sent), local - 1),
                "hashes": [hashes[ends[b] : ends[b + 1]].tobytes() for b in sent],
                "counts": [counts[ends[b] : ends[b + 1]].tobytes() for b in sent],
            }
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in target], schema=target)

    width = 1 << (bits - bucket_bits)

    def unite(table: pa.Table) -> pa.Table:
        missed = pc.sum(table.column("missed")).as_py()
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.uint64)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype=np.uint32)
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
        most = np.add.reduceat(counts, first) + missed if len(first) else counts
        seen = np.zeros(width, dtype=np.uint8)
        seen[((hashes[first][most >= support] >> np.uint64(64 - bits)) & np.uint64(width - 1)).astype(np.int64)] = 1
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "bits": pa.array([np.packbits(seen, bitorder="little").tobytes()], pa.binary())})

    rows = texts.mapInArrow(mine, columns).groupBy("bucket").applyInArrow(unite, "bucket int, bits binary")
    sieve = np.zeros((1 << bucket_bits, width // 8), dtype=np.uint8)
    for batch in rows.toArrow().to_batches():
        for bucket, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sieve[bucket] = np.frombuffer(part.as_buffer(), dtype=np.uint8)
    return sieve.reshape(-1)


def _counted(texts: DataFrame, sieve: np.ndarray, bits: int, support: int, longest: int) -> DataFrame:
    """The second pass: ``(lang, phrase, words, f)`` of all frequent phrases, and of the empty one, which is counted for every word."""
    spark = texts.sparkSession
    sieve_of = share(spark, sieve)
    columns = "lang string, phrase string, words int, f long"
    target = arrow_schema(spark.createDataFrame([], columns).schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = sieve_of()
        for lang, raw in _shards(batches):
            shard = Shard(lang, raw, longest)
            parts = [(pa.array([b""], pa.large_binary()), 0, [shard.n_words])]
            for (columns, counts), hashes in zip(shard.phrases, shard.hashes(), strict=True):
                at = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                held = np.flatnonzero((sieve[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                parts.append((shard.strings([c[held] for c in columns]), len(columns), counts[held]))
            for phrases, words, counts in parts:
                n = len(phrases)
                made = [pa.array([lang] * n, target.field(0).type), phrases.cast(target.field(1).type), np.full(n, words), counts]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, target, strict=True)], schema=target)

    return texts.mapInArrow(count, columns).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= support)


def frequent_phrases(
    documents: DataFrame, support: int = 10, longest: int = 3, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``(lang, phrase, words, f)``: every phrase of at most ``longest`` words with ``f >= support`` occurrences in its
    language, and with ``words`` 0 the empty phrase, counted once for every word, where a language has ``support`` words.

    A to Z are made small. Texts end pieces at ``. , ; : ! ?`` and line ends, pieces are cut into words at blanks and tabs;
    a phrase lies in one piece. A null text is empty, a null language is ``und``. Repeated rows count each time. Every text
    is taken whole: a long one is worked on in parts that end where a piece does. Other columns take no part.
    The driver gets the sieve alone, at most 2^MOST_BITS bits.
    """
    texts = documents.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    total = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    bits = min(MOST_BITS, max(LEAST_BITS, _power(total / BYTES_PER_BIT)))
    sieve = _union(texts, total, support, longest, bits)
    return _counted(texts, sieve, bits, support, longest)


def collocations(frequent: DataFrame, support: int = 10, top: int = 2000, inside: int = 50) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of two words and more for each language.

    ``frequent`` is what ``frequent_phrases`` gives. A phrase is cut after its first ``k`` words into parts with ``l`` and ``r``
    occurrences; the score is floor(1000000 * a * a / (l * r)) of the worst cut, the first such if tied. A phrase whose
    words lie inside a longer one with at least ``inside`` percent of its occurrences is left out. Order: score and
    ``a`` descending, then the phrase's bytes. Scores are exact: whole numbers of 38 digits, enough for counts to 10^15.
    """
    phrases = stored(frequent)
    kinds = phrases.where("words > 1").withColumnRenamed("f", "a")
    cuts = kinds.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("cut")).withColumn(
        "first", F.expr("substring_index(phrase, ' ', cut)")
    ).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = {x: F.col(x).cast("decimal(15,0)") for x in "alr"}
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumns({f"wide_{x}": c for x, c in wide.items()})
        .withColumn("score", F.expr("CAST((wide_a * wide_a * 1000000BD) div (wide_l * wide_r) AS BIGINT)"))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    )
    longer = (
        kinds.where("words > 2")
        .withColumn("word_list", F.split("phrase", " "))
        .select("lang", F.col("a").alias("longer_a"), "words", "word_list", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
        .select("lang", "longer_a", "word_list", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
        .groupBy("lang", F.expr("array_join(slice(word_list, at, size), ' ')").alias("phrase"))
        .agg(F.max("longer_a").alias("longer_a"))
    )
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    kept = (
        scored.join(longer, ["lang", "phrase"], "left")
        .where(f"longer_a IS NULL OR 100 * longer_a < {int(inside)} * a")
        .select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )
    return _ranked(stored(kept), top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language: first of groups of bounded size, then of what is left of them."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    groups = 1 + rows.count() // RANKED_TOGETHER
    within = Window.partitionBy("lang", "part").orderBy(*order)
    best = (
        rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
        .withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") <= top)
    )
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def mine(documents: DataFrame, support: int = 10, longest: int = 3, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """Collocations of all texts by language; see ``frequent_phrases`` and ``collocations``. An empty table gives no row."""
    return collocations(frequent_phrases(documents, support, longest, lang, text), support, top)
