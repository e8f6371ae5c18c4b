"""Token ids of a corpus in binary files of patched frame-of-reference blocks.

A file holds the ids of many documents one after another, cut into blocks of ``BLOCK`` ids. A block stores its
minimum, the other ids as differences from it, packed at the width that fits ``PERCENT`` of them, and a list of
exceptions (place and whole difference) for the rest. An index gives the byte at which every block starts, a second
one the documents, so that any range of ids is read without the blocks before it.

File layout, little endian::

    magic    4 bytes
    blocks   minimum u32, width u8, exceptions u8, 16 bytes for each bit of the width (one plane a bit, lowest first),
             a place u8 for each exception, a difference u32 for each exception
    index    a byte position u64 for every block, and the end of the last one
    docs     Arrow stream of (key, start, n): first id of a document within the file, number of its ids
    footer   ids u64, position of index u64, position of docs u64, magic

``write`` deals the documents out by ranges of their key; every task encodes its range and writes files of at most
``ids_per_file`` ids (one document may be longer). A file counts only if the manifest names it, a table written when
all files are there, so what a lost executor or a second attempt leaves behind is never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain, groupby
from operator import itemgetter
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemend.llm.bpe import SPACE, byte_letters
from tablemend.llm.common import arrow_schema, share, shared_path, ship

ship(__name__)

MAGIC = b"PFB1"
BLOCK = 128
#: Share of a block's ids that its width must fit.
PERCENT = 90
HEAD = 6
FOOTER = "<QQQ4s"
FOOTER_SIZE = struct.calcsize(FOOTER)
#: Ids in a file, ids and letters that a task works on at a time, and encoded units of text that it remembers.
IDS_PER_FILE = 1 << 26
RUN_IDS = 1 << 19
RUN_LETTERS = 1 << 22
REMEMBERED = 500_000
LONG_UNIT = 64
#: Units in one call of the library.
UNITS = 5000
#: A word in UTF-8, of letters of ASCII, Latin-1, Latin Extended-A, Greek and Cyrillic.
WORD = re.compile(
    rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4\xc5\xd0\xd1][\x80-\xbf]|\xce[\x91-\xa1\xa3-\xbf]|\xcf[\x80-\x8e])+"
)
#: Where a long text may be cut, white space beyond ASCII, and what a byte of ASCII is.
PLACE = re.compile(rf"[^{SPACE}](?=[{SPACE}])")
WIDE_SPACE = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
IS_SPACE = np.array([b in b"\t\n\x0b\x0c\r " for b in range(256)])
IS_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
IS_NAME = np.array([b < 128 and chr(b).isalnum() for b in range(256)])

MANIFEST = "part int, file int, path string, n_ids long, n_docs long, n_bytes long"


def _arrow_uri(uri: str) -> str:
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(_arrow_uri(uri)) if "://" in _arrow_uri(uri) else (fs.LocalFileSystem(), uri)


# Blocks


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of some ids and the length of each in bytes. The last block is filled up with its minimum."""
    n = len(ids)
    count = -(-n // BLOCK)
    if not count:
        return b"", np.zeros(0, dtype=np.int64)
    rows = np.empty(count * BLOCK, dtype=np.uint32)
    rows[:n] = ids
    rows[n:] = ids[(count - 1) * BLOCK :].min()
    rows = rows.reshape(count, BLOCK)
    low = rows.min(axis=1)
    rows = rows - low[:, None]
    at = -(-BLOCK * PERCENT // 100) - 1
    widths = np.frexp(np.partition(rows, at, axis=1)[:, at].astype(np.float64))[1]
    odd = rows >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    n_odd = odd.sum(axis=1)
    sizes = HEAD + BLOCK // 8 * widths + 5 * n_odd
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    out[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(count, 4)
    out[starts + 4] = widths
    out[starts + 5] = n_odd
    plain = np.where(odd, 0, rows)
    for bit in range(int(widths.max())):
        held = np.flatnonzero(widths > bit)
        plane = np.packbits((plain[held] >> np.uint32(bit)).astype(np.uint8) & 1, axis=1, bitorder="little")
        out[(starts[held] + HEAD + BLOCK // 8 * bit)[:, None] + np.arange(BLOCK // 8)] = plane
    block, place = np.nonzero(odd)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        lists = (starts + HEAD + BLOCK // 8 * widths)[block]
        out[lists + nth] = place
        whole = rows[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(lists + n_odd[block] + 4 * nth)[:, None] + np.arange(4)] = whole
    return out.tobytes(), sizes


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at these bytes of ``data``."""
    count = len(starts)
    if not count:
        return np.zeros(0, dtype=np.uint32)
    raw = np.frombuffer(data, dtype=np.uint8)
    low = np.ascontiguousarray(raw[starts[:, None] + np.arange(4)]).view("<u4")
    widths, n_odd = raw[starts + 4].astype(np.int64), raw[starts + 5].astype(np.int64)
    rows = np.zeros((count, BLOCK), dtype=np.uint32)
    for bit in range(int(widths.max())):
        held = np.flatnonzero(widths > bit)
        plane = raw[(starts[held] + HEAD + BLOCK // 8 * bit)[:, None] + np.arange(BLOCK // 8)]
        rows[held] |= np.unpackbits(plane, axis=1, bitorder="little").astype(np.uint32) << np.uint32(bit)
    block = np.repeat(np.arange(count), n_odd)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        lists = (starts + HEAD + BLOCK // 8 * widths)[block]
        at = (lists + n_odd[block] + 4 * nth)[:, None] + np.arange(4)
        rows[block, raw[lists + nth]] = np.ascontiguousarray(raw[at]).view("<u4")[:, 0]
    return (rows + low).reshape(-1)


# Files


class FileWriter:
    """One file: takes the ids of documents in turn, packs full blocks as they come."""

    def __init__(self, filesystem: fs.FileSystem, path: str, key: pa.DataType):
        self.path, self._key = path, key
        self._stream = filesystem.open_output_stream(path)
        self._stream.write(MAGIC)
        self._at, self.ids = len(MAGIC), 0
        self._open: list[np.ndarray] = []
        self._waiting = 0
        self._sizes: list[np.ndarray] = []
        self._docs: tuple[list, list, list] = ([], [], [])

    def add(self, key: object, runs: Iterator[np.ndarray]) -> None:
        start = self.ids
        for ids in runs:
            self._open.append(ids)
            self._waiting += len(ids)
            self.ids += len(ids)
            if self._waiting >= RUN_IDS:
                self._flush(self._waiting // BLOCK * BLOCK)
        for column, value in zip(self._docs, (key, start, self.ids - start), strict=True):
            column.append(value)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self._open) if self._open else np.zeros(0, dtype=np.uint32)
        data, sizes = pack(ids[:n])
        self._stream.write(data)
        self._at += len(data)
        self._sizes.append(sizes)
        self._open, self._waiting = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int, int]:
        """Ids, documents and bytes of the file."""
        self._flush(self._waiting)
        index_at = self._at
        ends = np.cumsum(np.concatenate(self._sizes)) + len(MAGIC)
        index = np.concatenate([[len(MAGIC)], ends]).astype("<u8").tobytes()
        docs = pa.RecordBatch.from_arrays(
            [pa.array(self._docs[0], self._key), pa.array(self._docs[1], pa.int64()), pa.array(self._docs[2], pa.int64())],
            ["key", "start", "n"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as stream:
            stream.write_batch(docs)
        table = sink.getvalue()
        docs_at = index_at + len(index)
        self._stream.write(index)
        self._stream.write(table)
        self._stream.write(struct.pack(FOOTER, self.ids, index_at, docs_at, MAGIC))
        self._stream.close()
        return self.ids, len(docs), docs_at + table.size + FOOTER_SIZE

    def abandon(self) -> None:
        self._stream.close()


class FileReader:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        filesystem, path = _open(uri)
        self._file = filesystem.open_input_file(path)
        size = self._file.size()
        self.ids, index_at, docs_at, magic = struct.unpack(FOOTER, self._part(size - FOOTER_SIZE, size))
        if magic != MAGIC or self._part(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is not a file of token blocks")
        self._index = np.frombuffer(self._part(index_at, docs_at), dtype="<u8").astype(np.int64)
        self.docs = pa.ipc.open_stream(self._part(docs_at, size - FOOTER_SIZE)).read_all()

    def _part(self, start: int, end: int) -> bytes:
        return self._file.read_at(end - start, start)

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from the ``start``-th on. Only the blocks that hold them are read."""
        if n <= 0:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // BLOCK, -(-(start + n) // BLOCK)
        bounds = self._index[first : last + 1]
        ids = unpack(self._part(int(bounds[0]), int(bounds[-1])), bounds[:-1] - bounds[0])
        return ids[start - first * BLOCK :][:n]

    def runs(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The same in pieces of at most ``RUN_IDS`` ids."""
        for at in range(start, start + n, RUN_IDS):
            yield self.read(at, min(RUN_IDS, start + n - at))

    def close(self) -> None:
        self._file.close()


# Texts to ids


class TextEncoder:
    """Ids of texts as the tokenizers library gives them, without special tokens added.

    A byte-level tokenizer with the usual pattern starts a new word wherever white space follows something else, or
    punctuation a letter or digit, whatever comes before or after. So texts are cut there, each distinct unit is encoded
    by the library once, and the ids of a text are put together from those of its units. With any other tokenizer
    whole texts go to the library.
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        parts = json.loads(spec)
        cutter = parts.get("pre_tokenizer") or {}
        added = parts.get("added_tokens", [])
        self._by_unit = (
            cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space", True)
            and not parts.get("normalizer")
            and not parts["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(rf"[{SPACE}]", t["content"]) for t in added)
        )
        #: Punctuation that follows a letter within an added token is no place to cut.
        inner = {b for t in added for a, b in zip(t["content"], t["content"][1:]) if a.isalnum()}
        self._marks = IS_MARK & ~np.array([chr(b) in inner for b in range(256)])
        special = [t for t in added if t["special"] and not t["normalized"]]
        self._between = (special[0]["content"], special[0]["id"]) if special else None
        #: A unit of letters is one word, which goes straight to the library's model, its bytes as the letters for them.
        self._words = parts["model"].get("type") == "BPE" and not any(t["content"].strip().isalpha() for t in added)
        self._letters = {byte: letter for letter, byte in byte_letters().items()}
        self._known: dict[bytes, bytes] = {}

    def runs(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """``(number of the text, ids)``, at least once for every text, a long one in pieces of bounded length."""
        if not self._by_unit:
            for i, text in enumerate(texts):
                ids = self._tokenizer.encode(text, add_special_tokens=False).ids
                yield i, np.array(ids, dtype="<u4")
            return
        group: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                group.append((i, piece))
                size += len(piece)
                if size >= RUN_LETTERS:
                    yield from self._group(group)
                    group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray]]:
        if not any(piece for _, piece in group):
            yield from ((i, np.zeros(0, dtype="<u4")) for i, _ in group)
            return
        raw = [piece.encode() for _, piece in group]
        ends = np.cumsum([0] + [len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        # A byte of a letter beyond ASCII may end a wide space: no cut after it where the text has any.
        left = ~IS_SPACE & (np.arange(256) > 32)
        narrow = np.repeat([not WIDE_SPACE.search(piece) for _, piece in group], np.diff(ends))
        before, after = data[:-1], data[1:]
        cut = IS_SPACE[after] & left[before] & ((before < 128) | narrow[:-1]) | self._marks[after] & IS_NAME[before]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[1:-1] = cut
        edge[ends] = True
        bounds = np.flatnonzero(edge)
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        found = self._found(units.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        unit = units.indices.to_numpy()
        counts = lengths[unit]
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat((np.cumsum(lengths) - lengths)[unit] - total[:-1], counts) + np.arange(total[-1])]
        split = total[np.searchsorted(bounds, ends)]
        for (i, _), a, b in zip(group, split, split[1:]):
            yield i, ids[a:b]

    def _found(self, units: list[bytes]) -> list[bytes]:
        known = self._known
        found = list(map(known.get, units))
        new = [u for u, ids in zip(units, found) if ids is None]
        if new:
            if len(known) + len(new) > REMEMBERED:
                # Those of this run stay, so the common ones always do.
                known = self._known = {u: ids for u, ids in zip(units, found) if ids is not None}
            made = self._encoded(new)
            known.update((u, ids) for u, ids in made.items() if len(u) <= LONG_UNIT)
            found = [made[u] if ids is None else ids for u, ids in zip(units, found)]
        return found


    def _encoded(self, units: list[bytes]) -> dict[bytes, bytes]:
        """The ids of distinct units."""
        is_word = list(map(WORD.fullmatch, units)) if self._words else [None] * len(units)
        words = [u for u, hit in zip(units, is_word) if hit]
        others = [u for u, hit in zip(units, is_word) if not hit]
        tokenize, letters = self._tokenizer.model.tokenize, self._letters
        found = [[t.id for t in tokenize(w.decode("latin-1").translate(letters))] for w in words]
        made = _split(words, list(chain.from_iterable(found)), list(map(len, found)))
        for i in range(0, len(others), UNITS):
            made |= self._by_library(others[i : i + UNITS])
        return made

    def _by_library(self, units: list[bytes]) -> dict[bytes, bytes]:
        """The same for units of any kind, in one call, with a token between them that never merges with text."""
        if self._between:
            text, between = self._between
            ids = np.array(self._tokenizer.encode(text.join(u.decode() for u in units), add_special_tokens=False).ids)
            ends = np.flatnonzero(ids == between)
            if len(ends) == len(units) - 1:  # so no unit holds that token
                return _split(units, ids[ids != between], np.diff(ends, prepend=-1, append=len(ids)) - 1)
        found = [e.ids for e in self._tokenizer.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)]
        return _split(units, list(chain.from_iterable(found)), list(map(len, found)))


def _split(units: list[bytes], ids: Sequence[int], lengths: Sequence[int]) -> dict[bytes, bytes]:
    """The ids of all units, one after another, as bytes for each unit."""
    data = np.array(ids, dtype="<u4").tobytes()
    ends = (4 * np.cumsum(lengths, dtype=np.int64)).tolist()
    return {u: data[a:b] for u, a, b in zip(units, [0, *ends], ends)}


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces of bounded length where it has places to cut it."""
    start = 0
    while len(text) - start > RUN_LETTERS:
        cut = PLACE.search(text, start + RUN_LETTERS)
        if not cut:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:] if start else text


# Spark


def write(
    documents: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    ids_per_file: int = IDS_PER_FILE,
) -> DataFrame:
    """Encode all texts and write them below ``folder`` in ascending order of their key; returns the manifest.

    ``folder`` is a path or URI that all executors reach; it must not exist. The manifest has a row for every file,
    whose order is ``(part, file)``; it is written to ``folder``/manifest. Every document, also one with a null or
    empty text, has its row in a file's index; ``end_id`` is appended to each. Null keys come first; rows with equal
    keys come in the order of a hash of their texts, and a hot key is split between tasks. Other columns take no
    part, whatever their names. A long text is encoded and packed in pieces of bounded length where it has white
    space. An empty table gives no file. The tokenizer file is read on the driver and broadcast.
    """
    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        encoder_of = share(spark, file.read(), TextEncoder)
    frame = documents.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).select("key", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("key").asc_nulls_first(), "tie", "row"]
    ranged = frame.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema, target = arrow_schema(ranged.schema), arrow_schema(spark.createDataFrame([], MANIFEST).schema)
    data = f"{folder}/data"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(), TaskContext.get().partitionId()
        filesystem, base = _open(data)
        filesystem.create_dir(base, recursive=True)
        tail = [] if end_id is None else [np.array([end_id], dtype="<u4")]
        file = None
        done = 0

        def closed() -> pa.RecordBatch:
            counts = file.close()
            row = [part, done, f"{data}/{file.path.rsplit('/', 1)[1]}", *counts]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, target, strict=True)], schema=target)

        try:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                for i, runs in groupby(encoder.runs(batch.column(1).to_pylist()), itemgetter(0)):
                    if file and file.ids >= ids_per_file:
                        yield closed()
                        file, done = None, done + 1
                    if not file:
                        file = FileWriter(filesystem, f"{base}/{part:06d}-{done:06d}-{uuid4().hex}.pfb", schema.field(0).type)
                    file.add(keys[i], chain((ids for _, ids in runs), tail))
            if file:
                yield closed()
                file = None
        finally:
            if file:
                file.abandon()

    ranged.mapInArrow(encode, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_back(spark: SparkSession, folder: str, key: str = "doc_id", key_type: str = "long", ids: bool = False) -> DataFrame:
    """Documents as the files hold them: ``(key, start, n_tokens, ids_crc32)``, and ``ids`` if asked for.

    ``start`` counts the ids of all documents before, over all files in order; ``ids_crc32`` is the unsigned checksum
    of a document's ids as little-endian unsigned 32-bit integers. Files are read in parallel, each block once or
    twice; a long document is read in pieces (whole only where ``ids`` are asked for). The sums of ids before a file
    come of the manifest, one row a file.
    """
    files = manifest(spark, folder).withColumn(
        "before", F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    columns = f"key {key_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    target = arrow_schema(spark.createDataFrame([], columns).schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = FileReader(uri)
                for docs in file.docs.to_batches(max_chunksize=1000):
                    starts, counts = docs.column(1).to_pylist(), docs.column(2).to_pylist()
                    found = list(_documents(file, starts, counts, ids))
                    made = [docs.column(0).cast(target.field(0).type), pa.array([before + s for s in starts], pa.int64()), docs.column(2)]
                    made.append(pa.array([c for c, _ in found], pa.int64()))
                    if ids:
                        made.append(pa.array([i for _, i in found], target.field(4).type))
                    yield pa.RecordBatch.from_arrays(made, schema=target)
                file.close()

    tasks = max(1, files.count())
    return files.select("path", "before").repartition(tasks).mapInArrow(read, columns).withColumnRenamed("key", key)


def _documents(file: FileReader, starts: list[int], counts: list[int], ids: bool) -> Iterator[tuple[int, np.ndarray | None]]:
    """Checksum and ids of documents that follow each other; short ones are read together."""
    i = 0
    while i < len(starts):
        j, size = i + 1, counts[i]
        while j < len(starts) and size + counts[j] <= RUN_IDS:
            size += counts[j]
            j += 1
        if j == i + 1 and not ids:
            crc = 0
            for run in file.runs(starts[i], counts[i]):
                crc = zlib.crc32(run.astype("<u4").tobytes(), crc)
            yield crc, None
        else:
            run = file.read(starts[i], size).astype("<u4")
            for k in range(i, j):
                part = run[starts[k] - starts[i] :][: counts[k]]
                yield zlib.crc32(part.tobytes()), part if ids else None
        i = j


def round_trip(documents: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents to a new folder of the shared store and read them back."""
    folder = shared_path(documents.sparkSession)
    write(documents, tokenizer_path, folder, end_id, key, text)
    return read_back(documents.sparkSession, folder, key, documents.schema[key].dataType.simpleString())
