"""Phrases by partitioned mining against counting everything."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tablemend.llm import collocations


def _brute(rows, support, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    often = {key: c for key, c in f.items() if c >= support}
    out = []
    for lang in {x for x, _ in often}:
        kinds = {p: c for (x, p), c in often.items() if x == lang and len(p) > 1}
        rows = []
        for p, a in kinds.items():
            longer = [c for q, c in kinds.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * c >= 50 * a for c in longer):
                continue
            cuts = [(1000000 * a * a // (often[lang, p[:k]] * often[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def _rows(seed, size):
    pick = random.Random(seed)
    words = ["a", "B", "b", "of", "the", "New", "york", "é", "É", "x", "(y)", "naïve", "\U0001f600"]
    gaps = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!", "\r\n", "\x0b"]
    rows = []
    for _ in range(size):
        words_here = pick.choices(words, weights=range(len(words), 0, -1), k=pick.randrange(30))
        rows.append(("".join(w + pick.choice(gaps) for w in words_here), pick.choice(["en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", "de"), (" , ", "xx"), ("one", "yy")] + [("same words here, again", "en")] * 40


def _run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "text string, lang string, phrase string, f int").repartition(4)
    return sorted(map(tuple, collocations.mine(docs, **options).collect()))


@pytest.mark.parametrize("shard", [collocations.SHARD_BYTES, 300])
@pytest.mark.parametrize("support, longest, top", [(10, 3, 2000), (3, 4, 7), (60, 2, 2000)])
def test_mined_phrases_equal_the_brute_force_ones(spark, monkeypatch, shard, support, longest, top):
    # Few large shards have local supports above 1, many small ones do not.
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard)
    rows = _rows(support, 300)
    assert _run(spark, rows, support=support, longest=longest, top=top) == _brute(rows, support, longest, top)


def test_equal_hashes_and_a_full_sieve_change_nothing(spark, monkeypatch):
    rows = _rows(5, 200)
    want = _brute(rows, 10, 3, 2000)
    monkeypatch.setattr(collocations.Shard, "hashes", lambda self: [np.zeros(len(c), dtype=np.uint64) for _, c in self.phrases])
    assert _run(spark, rows) == want


def test_ranking_in_groups(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANKED_TOGETHER", 3)
    rows = _rows(9, 200)
    assert _run(spark, rows, top=5) == _brute(rows, 10, 3, 5)


def test_a_long_text_is_cut_where_pieces_end(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 50)
    rows = [("alpha beta gamma, " * 100 + "alpha beta " * 30, "en")]
    assert "".join(collocations._pieces(rows[0][0])) == rows[0][0]
    assert _run(spark, rows) == _brute(rows, 10, 3, 2000)


def test_large_counts_are_exact(spark):
    big = 3_000_000_019
    rows = [("en", "", 0, 9 * big), ("en", "x", 1, 2 * big), ("en", "y", 1, 3 * big), ("en", "x y", 2, big)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    assert [tuple(r) for r in collocations.collocations(frequent).collect()] == [
        ("en", 1, "x y", big, 2 * big, 3 * big, 9 * big, 1000000 * big * big // (6 * big * big))
    ]


def test_no_texts_no_phrases(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(None, None), ("", "en")])[0:0] == []
