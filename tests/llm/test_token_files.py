"""Token files: blocks, units, files of several tasks, the query against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablemend.llm import token_files
from tablemend.llm.common import read, shared_path
from tablemend.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=600))
def test_blocks_round_trip(values):
    ids = np.array(values, dtype=np.uint32)
    data, sizes = token_files.pack(ids)
    assert sizes.sum() == len(data)
    assert token_files.unpack(data, np.cumsum(sizes) - sizes)[: len(ids)].tolist() == values


def test_width_fits_nine_tenths_and_the_rest_are_exceptions():
    ids = np.full(token_files.BLOCK, 1000, dtype=np.uint32)
    ids[:12] += 50_000
    ids[12:40] += 7
    data, sizes = token_files.pack(ids)
    assert data[4] == 3 and data[5] == 12
    assert sizes.tolist() == [token_files.HEAD + 16 * 3 + 5 * 12]


def _encoded(encoder, texts):
    out = [[] for _ in texts]
    for i, ids in encoder.runs(texts):
        out[i] += ids.tolist()
    return out


@pytest.mark.parametrize("letters", [token_files.RUN_LETTERS, 30])
def test_units_equal_the_library(monkeypatch, letters):
    monkeypatch.setattr(token_files, "RUN_LETTERS", letters)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.TextEncoder(file.read())
    assert encoder._by_unit
    pieces = [*"ab 's t1!,_\t\n\x0b\x1c\x1f\x85\xa0 　é中́​﻿᠎\x00²", "<|endoftext|>", "'re", "', "]
    pick = random.Random(7)
    texts = ["", " ", "x" * 300] + ["".join(pick.choice(pieces) for _ in range(pick.randrange(60))) for _ in range(4000)]
    texts += [f"ab{chr(c)}cd {chr(c)}, {chr(c)}{chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert _encoded(encoder, texts) == want


def test_a_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.TextEncoder(file.read())
    texts = ["one two three four", "four five six one", ""]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert _encoded(encoder, texts) == _encoded(encoder, texts) == want


def _brute(rows):
    """``(key, start, n_tokens, crc)`` of rows in their order."""
    library, at, out = Tokenizer.from_file(PATH), 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def _sort(row):
    return (row[0] is not None, row[0] or 0, row[1])


def test_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = sorted(tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect())
    got = QUERIES["op11_token_files"](spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == _brute(rows)


def test_nulls_ties_and_small_files(spark):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(300)]
    rows += [(None, None), (5, "text number 5 " * 5), (None, ""), (-3, "long " * 50_000), (7, "x" * 20_000)]
    docs = spark.createDataFrame([(k, t, "z", 1) for k, t in rows], "doc_id long, text string, start string, n_tokens int")
    folder = shared_path(spark)
    files = token_files.write(docs.repartition(5), PATH, folder, END, ids_per_file=500).collect()
    assert len(files) > 5
    got = token_files.read_back(spark, folder, ids=True).collect()
    library = Tokenizer.from_file(PATH)
    by_text = {t or "": [*library.encode(t or "", add_special_tokens=False).ids, END] for _, t in rows}
    assert sorted(str((r.doc_id, r.ids)) for r in got) == sorted(str((k, by_text[t or ""])) for k, t in rows)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.n_tokens for r in got)
    first = token_files.FileReader(max(files, key=lambda f: f.n_ids).path)
    whole = first.read(0, first.ids).tolist()
    for start, n in ((0, 1), (127, 2), (300, 129), (first.ids - 1, 1), (4, 0)):
        assert first.read(start, n).tolist() == whole[start : start + n]
    assert np.concatenate(list(first.runs(5, 1000))).tolist() == whole[5:1005]


def test_a_key_of_all_rows_is_dealt_to_several_tasks(spark):
    docs = spark.range(4000).selectExpr("1L AS doc_id", "'the same words' AS text").repartition(4)
    folder = shared_path(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        files = token_files.write(docs, PATH, folder, END).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(files) > 1 and max(f.n_docs for f in files) < 2000
    got = token_files.read_back(spark, folder)
    assert got.count() == 4000 and got.select("start").distinct().count() == 4000


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.round_trip(docs, PATH, END).collect() == []


def test_an_unlisted_file_is_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    folder = str(tmp_path / "tokens")
    token_files.write(docs, PATH, folder, END)
    (tmp_path / "tokens" / "data" / "000000-000009-left.pfb").write_bytes(b"left behind")
    assert sorted(r.doc_id for r in token_files.read_back(spark, folder).collect()) == [1, 2]
