"""BPE encoding and decoding with a contiguous array of ranks for every word.

A word keeps the boundaries of its parts and, beside them, the rank of every adjacent pair. The smallest rank is
found by a scan, its boundary deleted, and the two neighbouring ranks looked up again. Words are short, so that scan
beats any queue. A piece longer than ``LONG_PIECE`` bytes (a run without a break) is merged with a heap instead, in
the same order, as scanning it would take quadratic time.

The vocabulary is a file of the tokenizers library (byte-level BPE); its path is a parameter. It is read on the driver
and broadcast; its size does not depend on the data.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame

from tablemend.llm.common import in_batches, share, ship, texts_of

ship(__name__)

LONG_PIECE = 96
#: Words whose ids a task remembers. The memory is emptied when it is full.
REMEMBERED = 150_000
NO_RANK = 1 << 30
#: The public pattern that cuts text into words before any merge, with white space as Unicode defines it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


@dataclass(frozen=True)
class Vocabulary:
    """``pieces[id]`` are the bytes of a token; ``merges`` the pairs of ids in order of rank, with the id they make."""

    pieces: tuple[bytes, ...]
    merges: tuple[tuple[int, int, int], ...]
    special: tuple[tuple[str, int], ...]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by its public rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    by_id = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in special}
    by_id |= {i: token.encode() for token, i in special.items()}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    return Vocabulary(
        tuple(by_id[i] for i in range(len(by_id))),
        tuple((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs),
        tuple(sorted(special.items(), key=lambda t: (-len(t[0]), t[0]))),
    )


class Coder:
    """Encodes and decodes texts in a task."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces = vocabulary.pieces
        self.width = len(vocabulary.pieces)
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b, new) in enumerate(vocabulary.merges):
            self.ranks.setdefault(a * self.width + b, rank)
            self.made.append(new)
        special = {i for _, i in vocabulary.special}
        self.bytes = {p[0]: i for i, p in enumerate(vocabulary.pieces) if len(p) == 1 and i not in special}
        self.words = regex.compile(PATTERN)
        self.special = dict(vocabulary.special)
        self.cut = regex.compile("|".join(regex.escape(t) for t, _ in vocabulary.special)) if vocabulary.special else None
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        if not self.cut:
            return self._plain(text)
        ids, at = [], 0
        for hit in self.cut.finditer(text):
            ids += self._plain(text[at : hit.start()])
            ids.append(self.special[hit[0]])
            at = hit.end()
        return ids + self._plain(text[at:]) if at else self._plain(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")

    def _plain(self, text: str) -> list[int]:
        ids: list[int] = []
        known = self.known
        for word in self.words.findall(text):
            found = known.get(word)
            if found is None:
                found = self._word(word)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(word) <= LONG_PIECE:
                    known[word] = found
            ids += found
        return ids

    def _word(self, word: str) -> tuple[int, ...]:
        parts = [self.bytes[b] for b in word.encode()]
        return tuple(self._scan(parts) if len(parts) <= LONG_PIECE else self._heap(parts))

    def _scan(self, parts: list[int]) -> list[int]:
        width, get, made = self.width, self.ranks.get, self.made
        ranks = [get(a * width + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            at = ranks.index(best)
            parts[at] = made[best]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] * width + parts[at], NO_RANK)
            if at < len(ranks):
                ranks[at] = get(parts[at] * width + parts[at + 1], NO_RANK)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        n, width, get = len(parts), self.width, self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] * width + parts[i + 1])) is not None]
        heapify(queue)
        while queue:
            rank, i, a, b = heappop(queue)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get(parts[x] * width + parts[y])) is not None:
                    heappush(queue, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]


def encode(documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)`` of every row.

    A null or empty text has no ids. Special tokens in a text are encoded as such. Repeated rows and null keys give a
    row each; other columns take no part, whatever their names. Any text length is taken whole.
    """
    coder_of = share(documents.sparkSession, load_vocabulary(vocabulary_path), Coder)
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        coder = coder_of()
        return {"key": batch.column(0), "ids": [coder.encode(t.as_py()) for t in batch.column(1)]}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(frame, run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, vocabulary_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` of rows of ids. Null ids give an empty text; bytes that are not UTF-8 become U+FFFD."""
    coder_of = share(encoded.sparkSession, load_vocabulary(vocabulary_path), Coder)
    frame = encoded.select(key, ids).toDF("key", "ids")

    def run(batch):
        coder = coder_of()
        return {"key": batch.column(0), "text": [coder.decode(i or []) for i in batch.column(1).to_pylist()]}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(frame, run, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(
    documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``, and ``ids`` if asked for: encoded, decoded and summed up in one pass."""
    coder_of = share(documents.sparkSession, load_vocabulary(vocabulary_path), Coder)
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        coder = coder_of()
        names = [str(i) for i in range(coder.width)]
        counts, ids_sums, text_sums, all_ids = [], [], [], []
        for value in batch.column(1):
            ids = coder.encode(value.as_py())
            if with_ids:
                all_ids.append(ids)
            counts.append(len(ids))
            ids_sums.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            text_sums.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
        return {"key": batch.column(0), "n_tokens": counts, "ids_sha256": ids_sums, "decoded_sha256": text_sums, "ids": all_ids}

    kind = frame.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return in_batches(frame, run, schema).withColumnRenamed("key", key)
