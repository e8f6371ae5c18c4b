"""Repeated passages: windows of words that an earlier document holds, counted exactly by super-k-mers.

A window is ``WINDOW`` words in a row. Its minimiser is the smallest hash among its runs of ``RUN`` words; it
says which bucket the window belongs to, wherever the window occurs. Consecutive windows with one minimiser travel as one
packed string (their words joined by spaces), so a word is sent about three times instead of thirteen. The strings that
a task has for a bucket go as one compressed row. In the bucket all windows are sorted by hash; neighbours with equal hashes
are compared byte by byte, and every one whose document is not the smallest of its kind is reported back as a range of
words.

The number of buckets grows with the text, so each holds about ``BUCKET_BYTES`` of it. A bucket that gets far more, as a
passage or a whole document that very many share makes it, is split: its parts first pass on their distinct strings alone.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import in_batches, numbered, ship, stored
from tablemend.llm.words import Words, grams, mixed, runs, words_of

ship(__name__)

WINDOW = 13
RUN = 3
BUCKET_BYTES = 4_000_000
MIN_BUCKETS = 256
#: Windows that are compared byte by byte at a time.
COMPARED = 50_000
#: Super-k-mers of a bucket that is still taken whole; an even share is about 140,000. And buckets for a task, about.
LARGE = 300_000
BUCKETS_A_TASK = 4
RANGES = "row long, low int, high int"
#: The place of a document without a key: after all others.
LAST = (1 << 63) - 1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    reach, least = 1, values
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def windows_within(text_of: np.ndarray, window: int) -> np.ndarray:
    """Whether the window at each word ends in the same text."""
    size = max(0, len(text_of) - window + 1)
    return text_of[:size] == text_of[len(text_of) - size :]


def super_kmers(words: Words, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of every run of windows with one minimiser in one text."""
    text_of = words.text_of()
    at = np.flatnonzero(windows_within(text_of, window))
    if not len(at):
        return at, at, np.zeros(0, dtype=np.uint64)
    least = sliding_min(grams(words.hashes, run), window - run + 1)[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (text_of[at[1:]] != text_of[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), least[first]


def packed(words: Words) -> tuple[bytes, np.ndarray]:
    """All words, each followed by one space, and where each begins."""
    sizes = words.ends - words.starts + 1
    data = words.data.copy()
    change = np.zeros(len(data) + 1, dtype=np.int8)
    change[words.starts] = 1
    change[words.ends + 1] -= 1
    keep = np.cumsum(change[:-1]).astype(bool)
    data[words.ends] = 32
    return data[keep].tobytes(), np.concatenate([[0], np.cumsum(sizes)])


def _dealt(rows: np.ndarray, order: np.ndarray, texts: list[str], buckets: int, window: int) -> dict[int, tuple]:
    """What a run of texts sends to each bucket: documents, their order, first words and strings."""
    words = words_of(texts)
    first, count, least = super_kmers(words, window)
    if not len(first):
        return {}
    blob, begin = packed(words)
    text = words.text_of()[first]
    start = first - words.first[text]
    bucket = (mixed(least) % np.uint64(buckets)).astype(np.int64)
    low, high = begin[first].tolist(), (begin[first + count + window - 1] - 1).tolist()
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
    out = {}
    for part in np.split(by_bucket, cuts):
        strings = b"\n".join([blob[low[i] : high[i]] for i in part.tolist()])
        out[int(bucket[part[0]])] = (rows[text[part]], order[text[part]], start[part].astype(np.int32), strings)
    return out


def least_orders(order: np.ndarray, strings: list[bytes], window: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the strings; the first word and the string of every window; the smallest order that any equal window has."""
    words = words_of(strings)
    text_of = words.text_of()
    at = np.flatnonzero(windows_within(text_of, window))
    string = text_of[at]
    owner = order[string]
    key = grams(words.hashes, window)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    by_key = np.lexsort((owner, key))
    head = np.ones(len(at), dtype=bool)
    head[1:] = key[by_key][1:] != key[by_key][:-1]
    group = np.cumsum(head) - 1
    heads = by_key[head][group]
    least = np.empty(len(at), dtype=np.int64)
    least[by_key] = owner[heads]
    _undo_collisions(words, at, by_key, heads, group, owner, least, window)
    return words, at, string, least


def _undo_collisions(words, at, by_key, heads, group, owner, least, window) -> None:
    """Compare the bytes of equal hashes. Where they differ after all, the group is judged by its bytes."""
    data = words.data
    unlike = set()
    places = np.flatnonzero(owner[by_key] > owner[heads])
    for part in range(0, len(places), COMPARED):
        chosen = places[part : part + COMPARED]
        mine, theirs = at[by_key[chosen]], at[heads[chosen]]
        size = words.ends[mine + window - 1] - words.starts[mine]
        same = size == words.ends[theirs + window - 1] - words.starts[theirs]
        unlike.update(group[chosen[~same]].tolist())
        mine, theirs, size, chosen = mine[same], theirs[same], size[same], chosen[same]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        a = data[np.repeat(words.starts[mine], size) + inside]
        b = data[np.repeat(words.starts[theirs], size) + inside]
        unlike.update(group[np.repeat(chosen, size)[a != b]].tolist())
    for g in unlike:
        members, smallest = by_key[group == g], {}
        texts = [data[words.starts[at[i]] : words.ends[at[i] + window - 1]].tobytes() for i in members]
        for i, value in zip(members, texts):
            smallest[value] = min(smallest.get(value, owner[i]), owner[i])
        for i, value in zip(members, texts):
            least[i] = smallest[value]


def _runs(again: np.ndarray, place: np.ndarray, string: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, first and last word (exclusive) of every run of marked windows, given the place of each in its text."""
    hit = np.flatnonzero(again)
    word, of = place[hit], string[hit]
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (word[1:] != word[:-1] + 1) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
    return of[first], word[first], word[last] + window


def repeated_ranges(
    rows: np.ndarray, order: np.ndarray, start: np.ndarray, strings: list[bytes], window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last word (exclusive) of every run of windows that stand in a document of smaller order, too."""
    words, at, string, least = least_orders(order, strings, window)
    place = at - words.first[string] + start[string]
    of, low, high = _runs(order[string] > least, place, string, window)
    return rows[of], low, high


def _load(rows: np.ndarray, order: np.ndarray, start: np.ndarray, strings: bytes) -> bytes:
    return rows.tobytes() + (order - rows).tobytes() + start.astype(np.int32).tobytes() + strings


def _unload(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    codec = pa.Codec("zstd")
    rows, order, start, strings = [], [], [], []
    for size, n, load in zip(*(table.column(c).to_pylist() for c in ("size", "n", "load"))):
        raw = codec.decompress(load, size, asbytes=True)
        r = np.frombuffer(raw, np.int64, n)
        rows.append(r)
        order.append(r + np.frombuffer(raw, np.int64, n, 8 * n))
        start.append(np.frombuffer(raw, np.int32, n, 16 * n))
        strings += raw[20 * n :].split(b"\n")
    return np.concatenate(rows), np.concatenate(order), np.concatenate(start), strings


def _send(frame: DataFrame, buckets: int, window: int) -> DataFrame:
    """A row for each bucket and run of texts: compressed documents, orders, first words and strings."""

    def run(batch):
        codec = pa.Codec("zstd", 3)
        columns: dict[str, list] = {"bucket": [], "size": [], "n": [], "load": []}
        rows, order, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
        for a, b in runs(texts):
            for bucket, sent in _dealt(rows[a:b], order[a:b], texts[a:b], buckets, window).items():
                load = _load(*sent)
                columns["bucket"].append(bucket)
                columns["size"].append(len(load))
                columns["n"].append(len(sent[0]))
                columns["load"].append(codec.compress(load, asbytes=True))
        return columns

    return in_batches(frame, run, "bucket long, size long, n long, load binary")


def _ranges(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Table:
    return pa.table({"row": pa.array(row, pa.int64()), "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32())})


def _digest(value: bytes) -> bytes:
    """128 bits, of which no two different values are known to agree."""
    return blake2b(value, digest_size=16).digest()


def _solved(sent: DataFrame, tasks: int, window: int) -> DataFrame:
    """The repeated ranges of buckets that are taken whole."""

    def solve(table: pa.Table) -> pa.Table:
        return _ranges(*repeated_ranges(*_unload(table), window))

    return sent.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(solve, RANGES)


def _solved_in_parts(sent: DataFrame, parts: DataFrame, tasks: int, window: int) -> DataFrame:
    """The same for buckets that are split: ``parts`` has their number of parts.

    Every part passes on its distinct strings with the smallest order of each. Of these all windows are dealt out by
    their digests, so that each finds its smallest order wherever its strings came from; every part gets those of its own
    strings back and compares its documents with them. No step has all strings of a bucket in one place.
    """
    split = sent.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("load"), "parts").cast("int"))
    split = split.select("bucket", "part", "size", "n", "load")

    def distinct(key: tuple, table: pa.Table) -> pa.Table:
        _, order, _, strings = _unload(table)
        smallest: dict[bytes, int] = {}
        for o, value in zip(order.tolist(), strings):
            smallest[value] = min(smallest.get(value, o), o)
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()] * len(smallest), pa.int64()),
                "part": pa.array([key[1].as_py()] * len(smallest), pa.int32()),
                "string": pa.array(list(smallest), pa.binary()),
                "name": pa.array([_digest(value) for value in smallest], pa.binary()),
                "least": pa.array(list(smallest.values()), pa.int64()),
            }
        )

    def windows(batch):
        columns: dict[str, list] = {"bucket": [], "name": [], "at": [], "window": [], "least": []}
        for bucket, string, least in zip(*(batch.column(c).to_pylist() for c in ("bucket", "string", "least"))):
            words, name = string.split(b" "), _digest(string)
            for at in range(len(words) - window + 1):
                for column, value in zip(columns.values(), (bucket, name, at, _digest(b" ".join(words[at : at + window])), least)):
                    column.append(value)
        return columns

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _ranges(*(np.zeros(0, np.int64),) * 3)
        rows, order, start, strings = _unload(left)
        known = dict(zip(right.column("name").to_pylist(), (np.array(x, np.int64) for x in right.column("owners").to_pylist())))
        least = [known[_digest(value)] for value in strings]
        string = np.repeat(np.arange(len(strings)), [len(x) for x in least])
        inside = np.concatenate([np.arange(len(x)) for x in least])
        of, low, high = _runs(order[string] > np.concatenate(least), inside + start[string], string, window)
        return _ranges(rows[of], low, high)

    dealt = split.repartition(tasks, "bucket", "part")
    strings = stored(dealt.groupBy("bucket", "part").applyInArrow(distinct, "bucket long, part int, string binary, name binary, least long"))
    smallest = strings.groupBy("bucket", "string").agg(F.min("least").alias("least"))
    found = stored(in_batches(smallest, windows, "bucket long, name binary, at int, window binary, least long"))
    owner = found.groupBy("bucket", "window").agg(F.min("least").alias("owner"))
    owned = (
        found.join(owner, ["bucket", "window"])
        .groupBy("bucket", "name")
        .agg(F.sort_array(F.collect_list(F.struct("at", "owner"))).alias("owners"))
        .select("bucket", "name", F.col("owners.owner").alias("owners"))
    )
    sent_back = strings.select("bucket", "part", "name").join(owned, ["bucket", "name"]).select(
        F.col("bucket").alias("to_bucket"), F.col("part").alias("to_part"), "name", "owners"
    )
    both = dealt.groupBy("bucket", "part").cogroup(sent_back.groupBy("to_bucket", "to_part"))
    return both.applyInArrow(compare, RANGES)


def repeated_words(frame: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(row, low, high)``: ranges of words that repeat, for a frame of ``(row, place, text)`` with unique rows.

    A bucket with far more super-k-mers than others (a passage, or a document, that very many share) is split into parts.
    Which are split is found by counting all.
    """
    spark = frame.sparkSession
    size = frame.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-size // BUCKET_BYTES))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // BUCKETS_A_TASK)
    sent = _send(frame, buckets, window)
    counts = sent.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > LARGE)
    parts = stored(counts.select("bucket", F.ceil(F.col("n") / LARGE).cast("int").alias("parts")))
    if parts.isEmpty():
        return _solved(sent, tasks, window)
    whole = sent.join(parts, "bucket", "left_anti")
    return _solved(whole, tasks, window).unionAll(_solved_in_parts(sent, parts, tasks, window))


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(key, text, n_words, n_removed)``: the words that are left, joined by one space.

    Words are runs of anything but ASCII white space. A word goes if some window over it also starts in a document with a
    smaller key; all windows are judged on the input. Keys are whole numbers. A null key comes after all others. Rows of
    one key are judged each against the smaller keys alone, so equal rows of one key stay. Null and empty texts, and texts
    shorter than a window, lose nothing. Other columns take no part.
    """
    frame = numbered(documents, key, text).withColumn("place", F.coalesce(F.col("key").cast("long"), F.lit(LAST)))
    ranges = (
        repeated_words(frame.select("row", "place", "text"), window)
        .groupBy("row")
        .agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    )
    joined = frame.select("key", "row", "text").join(ranges, "row", "left").select("key", "text", "ranges")

    def run(batch):
        columns: dict[str, list] = {"text": [], "n_words": [], "n_removed": []}
        for value, found in zip(batch.column(1), batch.column(2)):
            words = value.as_py().encode().split()
            kept = _without(words, found.as_py())
            columns["text"].append(b" ".join(kept).decode())
            columns["n_words"].append(len(words))
            columns["n_removed"].append(len(words) - len(kept))
        return {"key": batch.column(0), **columns}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(joined, run, f"key {kind}, text string, n_words long, n_removed long").toDF(
        key, text, "n_words", "n_removed"
    )


def _without(words: list[bytes], ranges: list[dict] | None) -> list[bytes]:
    if not ranges:
        return words
    kept, at = [], 0
    for r in sorted((r["low"], r["high"]) for r in ranges):
        kept += words[at : r[0]]
        at = max(at, r[1])
    return kept + words[at:]


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` of what ``remove_repeats`` leaves."""
    return remove_repeats(documents, key, text).select(key, "n_words", "n_removed", F.sha2(text, 256).alias("kept_sha256"))
