"""Groups of documents with nearly the same word n-grams, by prefixes under several orders.

Two sets that overlap enough must share words in their first few under *any* order that all sets use. So a document
has to pass one order after the other, and a pair must be a candidate under each before it is verified:

1. Equal sets become one class, by a digest of their words; one representative goes on.
2. First order (by hash): a set with a partner shares at least ``need`` of its extended prefix with other sets. Counting
   the prefix words of all sets shows which sets do; most documents end here.
3. Second order (by another hash), for those left, with a longer prefix. Within it a third order, rarest first,
   names the few words that a partner must share.
4. Every such word has a hub, the set that holds it foremost. All sets are verified against their hubs; what is linked forms
   components. Sets in the hub's component need no more comparing with each other. The rest of a hub's group is
   compared in blocks with the group, inside the tasks: the filters of both orders are intersected, what remains is verified, and
   only links between different components are returned.
5. Filters and comparisons work on 64-bit hashes of shingles, made of strong hashes of words. What they find is compared
   once more by the words themselves, as 128-bit digests of the shingles' text, before it counts.

So no row is made for a pair that is not a link or a set with its hub. Words that many documents share are counted with
partial sums and joined by joins that adaptive execution can split. All links between different components are found; links
within a component are not needed for the groups and not listed.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import islice
from re import compile as pattern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import in_batches, numbered, only, ship, stored
from tablemend.llm.components import components
from tablemend.llm.words import grams, mixed, runs, words_of

ship(__name__)

#: Sets of a hub's group that are compared at a time, on either side.
BLOCK = 256
#: Bytes beyond which a text's words are not listed all at once, and shingles that are digested at a time.
LONG = 1 << 22
AT_ONCE = 1 << 20
WORD = pattern(rb"[^ \t-\r]+")
SECOND = 0x5851F42D4C957F2D


class Rule:
    """Which sets link, ``den * intersection >= num * union``, and what that says about prefixes."""

    def __init__(self, words: int, num: int, den: int):
        self.words, self.num, self.den = words, num, den

    def least(self, n):
        """The least overlap of a set of ``n`` with any partner."""
        return -(-self.num * n // self.den)

    def extra(self, n, order: int):
        """By how many words the prefix of an order is longer than it must be: the overlap it can ask for."""
        spare = n - self.least(n)
        return np.maximum(1, (spare + 1) // 2 if order == 1 else 2 * spare)

    def prefix(self, n, order: int):
        return np.minimum(n, n - self.least(n) + self.extra(n, order))

    def need(self, n, order: int):
        """What a set shares at least of its prefix with that of any partner, the smallest partner included."""
        return np.minimum(self.extra(n, order), self.extra(self.least(n), order))

    def links(self, shared, a, b):
        return self.den * shared >= self.num * (a + b - shared)


class RuleColumns(Rule):
    """The same for columns."""

    def least(self, n):
        return F.ceil(F.lit(self.num) * n / F.lit(self.den)).cast("long")

    def extra(self, n, order: int):
        spare = n - self.least(n)
        return F.greatest(F.lit(1), F.floor((spare + 1) / 2) if order == 1 else 2 * spare).cast("long")

    def prefix(self, n, order: int):
        return F.least(n, n - self.least(n) + self.extra(n, order))

    def need(self, n, order: int):
        return F.least(self.extra(n, order), self.extra(self.least(n), order))


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text after text in ascending order, and where each text begins.

    A text with fewer words is one shingle, its whole sequence; one without words has none. A to Z are made small.
    """
    found = words_of(texts, small=True, strong=True)
    counts = np.diff(found.first)
    text_of = found.text_of()
    whole = grams(found.hashes, words)
    size = len(whole)
    inside = np.flatnonzero(text_of[:size] == text_of[words - 1 :][:size]) if size else np.zeros(0, np.int64)
    hashes, owner = [whole[inside]], [text_of[inside]]
    for n in range(1, words):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes.append(mixed(grams(found.hashes, n)[found.first[short]] + np.uint64(n)))
            owner.append(short)
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def _lists(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(begin, pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of several runs as one."""
    values = np.concatenate([p[0] for p in parts])
    sizes = np.concatenate([np.diff(p[1]) for p in parts])
    return values, np.concatenate([[0], np.cumsum(sizes)])


def _sets_of(batch, column: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    texts = batch.column(column).to_pylist()
    return _joined([shingle_sets(texts[a:b], words) for a, b in runs(texts)] or [(np.zeros(0, np.uint64), np.zeros(1, np.int64))])


def _shingles(text: str, words: int) -> Iterator[bytes]:
    """The shingles of a text, word for word, repeated ones included."""
    raw = text.encode().lower()  # of bytes: A to Z alone
    if len(raw) <= LONG:
        found = raw.split()
        if 0 < len(found) < words:
            return iter([b" ".join(found)])
        return map(b" ".join, zip(*(found[i:] for i in range(words))))
    return _long_shingles(raw, words)


def _long_shingles(raw: bytes, words: int) -> Iterator[bytes]:
    last: deque[bytes] = deque(maxlen=words)
    count = 0
    for word in WORD.finditer(raw):
        last.append(word[0])
        count += 1
        if count >= words:
            yield b" ".join(last)
    if 0 < count < words:
        yield b" ".join(last)


def digests_of(text: str, words: int) -> np.ndarray:
    """A digest of every distinct shingle, ascending: 128 bits, of which no two different texts are known to agree."""
    shingles, found = _shingles(text, words), np.zeros(0, dtype="S16")
    while part := list(islice(shingles, AT_ONCE)):
        made = b"".join([blake2b(x, digest_size=16).digest() for x in part])
        found = np.union1d(found, np.frombuffer(made, dtype="S16"))
    return found


def _sketches(frame: DataFrame, rule: Rule) -> DataFrame:
    """``(key, row, n, print)``: the size of every set and a digest of it, by its words."""
    words = rule.words

    def run(batch):
        sizes, prints = [], []
        for text in batch.column(2):
            found = digests_of(text.as_py(), words)
            sizes.append(len(found))
            prints.append(sha256(found.tobytes()).digest())
        return {"key": batch.column(0), "row": batch.column(1), "n": sizes, "print": prints}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(frame.select("key", "row", "text"), run, f"key {kind}, row long, n long, print binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` that link by their words."""
    words = rule.words
    first = texts.select(F.col("row").alias("a"), F.col("text").alias("ta"))
    second = texts.select(F.col("row").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(first, "a").join(second, "b").select("a", "ta", "b", "tb")

    def run(batch):
        known: dict[int, np.ndarray] = {}  # a hub's text comes many times
        keep = []
        a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for i in range(len(a)):
            for row, column in ((a[i], 1), (b[i], 3)):
                if row not in known:
                    if len(known) > 200:
                        known.clear()
                    known[row] = digests_of(batch.column(column)[i].as_py(), words)
            x = known[a[i]] if a[i] in known else digests_of(batch.column(1)[i].as_py(), words)
            shared = len(np.intersect1d(x, known[b[i]], assume_unique=True))
            keep.append(rule.links(shared, len(x), len(known[b[i]])))
        keep = pa.array(keep, pa.bool_())
        return {"a": batch.column(0).filter(keep), "b": batch.column(2).filter(keep)}

    return in_batches(both, run, "a long, b long")


def in_order(values: np.ndarray, begin: np.ndarray, order: int) -> np.ndarray:
    """The sets under the order: the first is by hash, as they are; the second by another hash."""
    if order == 1:
        return values
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    return values[np.lexsort((mixed(values ^ np.uint64(SECOND)), owner))]


def prefixes(values: np.ndarray, begin: np.ndarray, rule: Rule, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The extended prefix of every set under an order."""
    size = np.diff(begin)
    cut = rule.prefix(size, order)
    place = np.arange(len(values)) - np.repeat(begin[:-1], size)
    return in_order(values, begin, order)[place < np.repeat(cut, size)], np.concatenate([[0], np.cumsum(cut)])


def _words_of_prefix(frame: DataFrame, rule: Rule, order: int) -> DataFrame:
    """``(row, n, word)``: the extended prefix of every set under an order."""

    def run(batch):
        values, begin = _sets_of(batch, 1, rule.words)
        return {"row": batch.column(0), "n": np.diff(begin), "words": _lists(*prefixes(values, begin, rule, order))}

    lists = stored(in_batches(frame, run, "row long, n long, words array<long>"))
    return lists.select("row", "n", F.explode("words").alias("word"))


def _shared_words(words: DataFrame) -> DataFrame:
    """``(row, n, word, df)`` of the words that at least two sets have."""
    df = words.groupBy("word").agg(F.count("*").alias("df")).where("df > 1")
    return words.join(df, "word")


def _keys(shared: DataFrame, rule: RuleColumns) -> DataFrame:
    """``(word, row, place)``: the rarest words of the second prefix, of which a partner must have one."""
    n = F.col("n")
    found = shared.groupBy("row", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", F.xxhash64("word").alias("tie"), "word"))).alias("words")
    )
    single = rule.prefix(n, 2) - F.size("words")
    take = F.greatest(F.lit(0), rule.prefix(n, 2) - rule.need(n, 2) + 1 - single)
    kept = found.where(F.size("words") >= rule.need(n, 2)).select(
        "row", single.alias("single"), F.posexplode(F.slice("words", F.lit(1), take.cast("int"))).alias("at", "w")
    )
    return kept.select("row", F.col("w.word").alias("word"), (F.col("single") + F.col("at")).alias("place"))


def _members(keys: DataFrame) -> DataFrame:
    """``(hub, row)``: every set with the hubs of its words. The hub of a word is the set that holds it foremost."""
    hubs = keys.groupBy("word").agg(F.min(F.struct("place", "row")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    return keys.join(hubs, "word").select(F.col("hub.row").alias("hub"), "row").where("hub <> row").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule, columns: RuleColumns) -> DataFrame:
    """The pairs ``(a, b)`` that link."""
    first = sets.select(F.col("row").alias("a"), F.col("n").alias("na"), F.col("words").alias("wa"))
    second = sets.select(F.col("row").alias("b"), F.col("n").alias("nb"), F.col("words").alias("wb"))
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    head = lambda w, n: F.slice(w, F.lit(1), columns.prefix(F.col(n), 1).cast("int"))
    shared = F.size(F.array_intersect("wa", "wb"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .where(rule.den * small >= rule.num * large)
        .where(F.arrays_overlap(head("wa", "na"), head("wb", "nb")))
        .where(rule.links(shared, F.col("na"), F.col("nb")))
        .select("a", "b")
    )


def counts_of(chosen: np.ndarray, values: np.ndarray, begin: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """How many of its values each list shares with the chosen ones. Values are small numbers; ``flags`` is work space."""
    flags[chosen] = True
    sums = np.concatenate([[0], np.cumsum(flags[values])])
    flags[chosen] = False
    return sums[begin[1:]] - sums[begin[:-1]]


def block_links(row, component, side, values, begin, rule: Rule) -> list[tuple[int, int]]:
    """Links between sets of different components, both on side 0 or on either side."""
    size = np.diff(begin)
    names, numbers = np.unique(values, return_inverse=True)
    flags, parts = np.zeros(len(names), dtype=bool), []
    for order in (1, 2):
        head, head_begin = prefixes(values, begin, rule, order)
        parts.append((np.searchsorted(names, head), head_begin, rule.need(size, order)))
    out = []
    for i in np.flatnonzero(side == 0):
        other = (component != component[i]) & ((side != 0) | (np.arange(len(row)) > i))
        other &= rule.den * np.minimum(size, size[i]) >= rule.num * np.maximum(size, size[i])
        for head, head_begin, need in parts:
            if other.any():
                shared = counts_of(head[head_begin[i] : head_begin[i + 1]], head, head_begin, flags)
                other &= shared >= np.minimum(need, need[i])
        if other.any():
            shared = counts_of(numbers[begin[i] : begin[i + 1]], numbers, begin, flags)
            for j in np.flatnonzero(other & rule.links(shared, size, size[i])):
                out.append((int(row[i]), int(row[j])))
    return out


def _rest(members: DataFrame, known: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links that a hub's group holds beside those to the hub: sets outside the hub's component against the group."""
    own = known.withColumnsRenamed({"id": "row", "component": "c"})
    of_hub = known.withColumnsRenamed({"id": "hub", "component": "hub_c"})
    placed = (
        members.join(own, "row", "left")
        .join(of_hub, "hub", "left")
        .select(
            "hub",
            "row",
            F.coalesce("c", "row").alias("component"),
            (F.coalesce("c", "row") == F.coalesce("hub_c", "hub")).alias("linked"),
        )
    )
    placed = stored(placed)
    sizes = placed.groupBy("hub").agg(F.count_if(~F.col("linked")).alias("apart"), F.count_if("linked").alias("near"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sizes = sizes.where("apart > 0 AND apart + near > 1").select("hub", blocks("apart").alias("apart"), blocks("near").alias("near"))
    rows = placed.join(sizes, "hub")
    mine = F.pmod(F.xxhash64("row"), F.when(F.col("linked"), F.col("near")).otherwise(F.col("apart"))).cast("int")
    rows = rows.withColumn("mine", mine)
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    place = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    none = F.array().cast("array<struct<kind:int,i:int,j:int>>")
    apart = F.transform(upto("apart"), lambda j: place(0, F.least(j, "mine"), F.greatest(j, "mine")))
    across = F.when(F.col("near") > 0, F.transform(upto("near"), lambda j: place(1, F.col("mine"), j))).otherwise(none)
    near = F.transform(upto("apart"), lambda i: place(1, i, F.col("mine")))
    tasks = F.when(F.col("linked"), near).otherwise(F.concat(apart, across))
    dealt = rows.join(sets.select("row", "words"), "row").select(
        "hub", F.explode(tasks).alias("task"), "row", "component", F.col("linked").cast("int").alias("side"), "words"
    )
    dealt = dealt.select("hub", "task.kind", "task.i", "task.j", "row", "component", "side", "words")

    def solve(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        row, component, side = (table.column(c).to_numpy() for c in ("row", "component", "side"))
        links = []
        if len(row) > 1:
            lists = table.column("words").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            begin = np.asarray(lists.offsets, dtype=np.int64)
            values = lists.values.to_numpy()[begin[0] : begin[-1]].view(np.uint64)
            links = block_links(row, component, side, values, begin - begin[0], rule)
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return dealt.groupBy("hub", "kind", "i", "j").applyInArrow(solve, "a long, b long")


def similar_groups(
    documents: DataFrame, words: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(row, key, n_shingles, component_id, leads)`` for every row: its group, and whether it is the one to keep.

    A document's set are its distinct shingles of ``words`` words (anything but ASCII white space; A to Z made small); with
    fewer words, the whole sequence. Documents link when ``den * intersection >= num * union``. ``component_id`` is the
    smallest key that can be reached by links, the own one included. Texts of any length are taken whole. A text that is null or has no words is linked with
    nothing. Rows that share a key are documents each. A null key is no name for a group that has another. ``leads`` is true for
    one row of each group: the one with the smallest key (and for each row without words).
    """
    return _groups(numbered(documents, key, text), words, num, den)


def _groups(frame: DataFrame, words: int, num: int, den: int) -> DataFrame:
    rule, columns = Rule(words, num, den), RuleColumns(words, num, den)
    sketches = stored(_sketches(frame, rule))
    classes = stored(
        sketches.where("n > 0")
        .groupBy("n", "print")
        .agg(F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col("row"))).alias("least"), F.min("row").alias("rep"))
        .select("n", "print", "rep", F.col("least.key").alias("least_key"), F.col("least.row").alias("least_row"))
    )
    texts = frame.select("row", "text")
    first = _shared_words(_words_of_prefix(only(texts, classes.select(F.col("rep").alias("row")), "row"), rule, 1))
    left = stored(
        first.groupBy("row", "n").agg(F.count("*").alias("shared")).where(F.col("shared") >= columns.need(F.col("n"), 1)).select("row")
    )
    keys = stored(_keys(_shared_words(_words_of_prefix(only(texts, left, "row"), rule, 2)), columns))
    members = stored(_members(keys))
    involved = stored(members.select("row").unionAll(members.select(F.col("hub").alias("row"))).distinct())
    whole = only(texts, involved, "row")
    sets = stored(_whole_sets(whole, rule))
    found = stored(_verified(members.select(F.col("row").alias("a"), F.col("hub").alias("b")), sets, rule, columns))
    links = stored(_confirmed(found, whole, rule))
    rest = _confirmed(_rest(members, components(links), sets, rule).distinct(), whole, rule)
    return _labelled(sketches, classes, components(links.unionAll(rest)))


def _whole_sets(frame: DataFrame, rule: Rule) -> DataFrame:
    """``(row, n, words)``: all shingles of every set, in the first order."""

    def run(batch):
        values, begin = _sets_of(batch, 1, rule.words)
        return {"row": batch.column(0), "n": np.diff(begin), "words": _lists(values, begin)}

    return in_batches(frame, run, "row long, n long, words array<long>")


def _labelled(sketches: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Give every row the smallest key of its group."""
    named = classes.join(groups.withColumnRenamed("id", "rep"), "rep")
    smallest = named.groupBy("component").agg(
        F.min(F.struct(F.col("least_key").isNull(), F.col("least_key"), F.col("least_row"))).alias("least")
    )
    named = named.join(smallest, "component").select(
        "n", "print", F.col("least.least_key").alias("group_key"), F.col("least.least_row").alias("group_row")
    )
    # Written, so that the last join has plain exchanges on both sides: a class with a third of the rows can be split.
    of_class = classes.join(named, ["n", "print"], "left").select(
        "n",
        "print",
        F.when(F.col("group_row").isNull(), F.col("least_key")).otherwise(F.col("group_key")).alias("group_key"),
        F.coalesce("group_row", "least_row").alias("group_row"),
    )
    joined = sketches.join(stored(of_class), ["n", "print"], "left")
    return joined.select(
        "row",
        "key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("group_key")).otherwise(F.col("key")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("group_row"), F.lit(True)).alias("leads"),
    )


def grouped(
    documents: DataFrame, words: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_shingles, component_id)`` of ``similar_groups``."""
    found = similar_groups(documents, words, num, den, key, text)
    return found.select(F.col("key").alias(key), "n_shingles", "component_id")


def keep_one(
    documents: DataFrame, words: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, that lead their group: one document of each, the one with the smallest key."""
    frame = numbered(documents, key, text, all_columns=True)
    groups = _groups(frame.select("key", "row", "text"), words, num, den)
    dropped = stored(groups.where("NOT leads").select("row"))
    return frame.join(dropped, "row", "left_anti").select("columns.*")
