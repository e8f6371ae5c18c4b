"""Leaks, lines, nearest vectors, similar groups and repeated passages against brute force, and the pipeline."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablemend.llm import decontaminate, jaccard, line_dedup, substring_dedup, topk
from tablemend.llm.components import components

SORT = lambda rows: sorted(rows, key=str)


# --- leaks --------------------------------------------------------------------


def test_longest_stretch():
    rng = random.Random(1)
    for _ in range(500):
        equal = np.array([rng.random() < rng.choice([0.5, 0.8, 0.95]) for _ in range(rng.randint(0, 30))], bool)
        a, b = decontaminate.longest_stretch(equal)
        n = len(equal)
        best = max((j - i for i in range(n + 1) for j in range(i, n + 1) if 5 * equal[i:j].sum() >= 4 * (j - i)), default=0)
        assert b - a == best and 5 * equal[a:b].sum() >= 4 * (b - a)


def leaks_by_hand(text, item):
    text, item = (re.findall(r"\w+", (t or "").lower()) for t in (text, item))
    best = 0
    for shift in range(-len(item), len(text) + 1):
        low, high = max(0, shift), min(len(text), shift + len(item))
        if high > low:
            equal = np.array([text[p] == item[p - shift] for p in range(low, high)])
            a, b = decontaminate.longest_stretch(equal)
            if b - a >= 13 or (9 <= len(item) == b - a and equal[a:b].all()):
                best = max(best, b - a)
    return best


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 25])
def test_leaks(spark, block_words):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 5, 8, 9, 12, 13, 20, 30)] + [None]
    texts = [None, "", "x " * 5000]
    for _ in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        copy = [w if rng.random() > 0.12 else "x" for w in (rng.choice(items) or "").split()]
        at = rng.randint(0, len(text))
        texts.append(rng.choice([" ", ", ", "\n"]).join(text[:at] + copy + text[at:]).replace("w1", rng.choice(["w1", "W1"])))
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] * 2, "item_id long, text string")
    want = {(i, j): n for i, t in enumerate(texts) for j, s in enumerate(items) if (n := leaks_by_hand(t, s))}
    found = decontaminate.find_leaks(docs, bench, block_words=block_words).collect()
    assert {(r.doc_id, r.item_id): r.n_words for r in found} == want and len(found) == len(want) > 10
    kept = decontaminate.drop_contaminated(docs, bench, block_words=block_words)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == decontaminate.find_leaks(docs.limit(0), bench).count() == 0


# --- lines --------------------------------------------------------------------


def test_lines(spark):
    rng = random.Random(4)
    hosts = ["a", "a", "a", "b", "c", "", None]
    pages = []
    for i in range(300):
        lines = [rng.choice(["menu", " menu ", "rare", "", "  ", f"own {i}", "foot", f"t{i % 40}"]) for _ in range(rng.randint(0, 8))]
        pages.append((rng.choice([i, i // 3, None]), rng.choice(hosts), rng.choice(["\n".join(lines)] * 9 + [None]), 7))
    pages += pages[:10]
    df = spark.createDataFrame(pages, "id long, host string, text string, n_lines int")
    total, count = {}, {}
    for _, host, text, _ in pages:
        total[host or ""] = total.get(host or "", 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            count[host or "", line] = count.get((host or "", line), 0) + 1
    often = {k for k, n in count.items() if n >= 5 and n > 0.1 * total[k[0]]}
    want = []
    for key, host, text, _ in pages:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if (host or "", x.strip(" ")) not in often]
        filled = [x for x in lines if x.strip(" ")]
        want.append((key, host, None if text is None else "\n".join(kept), len(filled), len(lines) - len(kept)))
    got = line_dedup.drop_boilerplate(df, F.col("host"), "id", ratio=0.1, min_pages=5)
    assert got.columns == ["id", "host", "text", "n_lines", "n_dropped"]
    assert SORT(map(tuple, got.collect())) == SORT(want)
    assert any(w[4] for w in want) and line_dedup.drop_boilerplate(df.limit(0), F.col("host"), "id").count() == 0


def test_rotating_lines_of_a_large_source(spark):
    docs = [(i, f"own {i}\nfooter {i % 60}\nadvert {i % 45}", "large", 0) for i in range(1800)]
    docs += [(5000 + i, f"own {i}\n{'four times' if i < 4 else 'five times' if i < 9 else 'x'}", "small", 0) for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.drop_boilerplate_lines(spark, df, "").collect()}
    assert all(got[i].text == f"own {i}" for i in range(1800))
    assert [got[5000 + i].text for i in (0, 8)] == ["own 0\nfour times", "own 8"]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_lines_of_html(spark):
    html = "<p>one<br>two <b>three</b></p><script>x<p>y</script><!-- no --><div class='a'>four</div>"
    df = spark.createDataFrame([(html, "HTTP://u:p@Ex.org:80/a"), (None, None)], "html string, url string")
    rows = df.select(line_dedup.lines_of_html(F.col("html")), line_dedup.host_of(F.col("url"))).collect()
    assert [x for x in rows[0][0].split("\n") if x] == ["one", "two three", "four"] and rows[0][1] == "ex.org"
    assert tuple(rows[1]) == (None, "")


# --- nearest vectors ----------------------------------------------------------


@pytest.mark.parametrize("chunk", [topk.QUERY_CHUNK, 7])
def test_topk(spark, monkeypatch, chunk):
    monkeypatch.setattr(topk, "QUERY_CHUNK", chunk)
    rng = np.random.default_rng(5)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(700)]
    vectors += [(1000 + i, [0.5] * 6) for i in range(300)]
    vectors += [(2000, None), (2001, [1.0, None, 0.0]), (2002, [float("nan")] + [0.0] * 5), (2003, [float("inf")] * 6)]
    vectors += [(None, [9.0] * 6), (2020, []), (2021, [3.0, 3.0]), (5, vectors[5][1])]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, score string")
    usable = [(i, np.floor(64 * np.array((v + [0.0] * 6)[:6]))) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for query in sorted({i for i, _ in usable if i % 20 == 0}):
        q = next(v for i, v in usable if i == query)
        best = sorted((-int(q @ v), i) for i, v in usable if i != query)[:20]
        want += [(query, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = topk.top_k(df, F.col("vec_id") % 20 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(df.where("vec_id IN (0, 1)"), F.col("vec_id") % 20 == 0).count() == 1


def test_scores_are_exact_beyond_doubles():
    a = np.array([[2.0**40, 1.0], [2.0**62, 2.0**62]])
    assert topk.scores_of(a, a).tolist() == [[2**63 - 1, 2**63 - 1]] * 2
    b = np.array([[2.0**30, 3.0]])
    assert topk.scores_of(b, b).tolist() == [[2**60 + 9]]


# --- similar groups -----------------------------------------------------------


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (101, 100), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.component for r in components(df).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}
    assert components(df.limit(0)).count() == 0


def groups_by_hand(rows, k, num, den):
    sets = []
    for _, text in rows:
        small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0d]+", small)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and den * shared >= num * (len(a) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(key, len(s), least.get(root(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("seed,k,num,odd", [(1, 3, 90, False), (2, 3, 90, False), (3, 5, 80, True), (4, 2, 70, True)])
def test_similar_groups(spark, monkeypatch, seed, k, num, odd):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400 if seed % 2 else 40)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 30, 80, 200]))] for _ in range(12)]
    common, rows = [rng.choice(words) for _ in range(25)], []
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            j, what = rng.randrange(len(w)), rng.random()
            if what < 0.5:
                w[j] = rng.choice(words)
            elif what < 0.8:
                w.insert(j, rng.choice(words))
            elif len(w) > 1:
                del w[j]
        text = rng.choice([" ", "  ", "\n"]).join(w + common * (rng.random() < 0.3))
        text = text.upper() if rng.random() < 0.1 else rng.choice(["", None, " \n"]) if rng.random() < 0.06 else text
        rows.append((rng.choice([i, i, i // 3, None]) if odd else i, text))
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string").repartition(3)
    want = groups_by_hand(rows, k, num, 100)
    assert SORT(map(tuple, jaccard.grouped(df, k, num, 100).collect())) == SORT(want)
    kept = jaccard.keep_one(df, k, num, 100)
    assert kept.columns == df.columns
    if not odd:
        assert {r.doc_id for r in kept.collect()} == {key for key, _, component in want if key == component}


def test_similar_groups_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.grouped(empty).count() == jaccard.keep_one(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.grouped(blank).collect())) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert jaccard.keep_one(blank).count() == 3


# --- repeated passages --------------------------------------------------------


def repeats_by_hand(rows, window):
    texts, first, last = [(k, (t or "").encode().split()) for k, t in rows], {}, 1 << 63
    place = lambda k: last if k is None else k
    for key, w in texts:
        for i in range(len(w) - window + 1):
            p = tuple(w[i : i + window])
            first[p] = min(first.get(p, last), place(key))
    out = []
    for key, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < place(key):
                gone.update(range(i, i + window))
        out.append((key, b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), len(w), len(gone)))
    return out


@pytest.mark.parametrize("seed,large", [(0, 300_000), (1, 300_000), (2, 5), (3, 5), (4, 1)])
def test_repeated_passages(spark, monkeypatch, seed, large):
    monkeypatch.setattr(substring_dedup, "LARGE", large)
    monkeypatch.setattr(substring_dedup, "MIN_BUCKETS", 7)
    rng = random.Random(seed)
    words = ["a", "b", "c", "dé", "e"] if seed % 2 else [f"w{i}" for i in range(30)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "\n", "\t \xa0"]) for _ in range(rng.randint(0, 60)))
        if rows and rng.random() < 0.5:
            other = (rng.choice(rows)[1] or "").split(" ")
            at = rng.randint(0, len(other))
            text += " " + " ".join(other[at : at + rng.randint(0, 40)])
        rows.append((rng.choice([i, i, i, i // 2, None]) if seed >= 2 else i, rng.choice([text, text, text, text, None, ""])))
    rows += rows[:5] if seed >= 2 else []
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int").repartition(3)
    assert SORT(map(tuple, substring_dedup.remove_repeats(df, window=5).collect())) == SORT(repeats_by_hand(rows, 5))
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_equal_hashes_are_compared_by_bytes(monkeypatch):
    monkeypatch.setattr(substring_dedup, "grams", lambda hashes, n: np.zeros(max(0, len(hashes) - n + 1), np.uint64))
    strings = [b"a b c d", b"x b c d", b"a b c d"]
    place, start = np.array([1, 2, 3]), np.zeros(3, np.int32)
    found = substring_dedup.repeated_ranges(place, place, start, strings, 3)
    assert sorted(zip(*(f.tolist() for f in found))) == [(2, 1, 4), (3, 0, 4)]


# --- pipeline -----------------------------------------------------------------


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir).cache()
        rows = {r.doc_id: r for r in after.collect()}
        if name != "tokens":
            assert after.columns == docs.columns
        if name == "quality":
            assert sum(labels[i] for i in before.keys() - rows.keys() if i in labels) <= 3
            assert sum(1 - labels[i] for i in rows if i in labels) <= 3
        elif name == "lines":
            assert rows.keys() == before.keys()
            assert all(set(r.text.split("\n")) <= set(before[i].text.split("\n")) | {""} for i, r in rows.items())
        elif name == "near_copies":
            found = groups_by_hand([(i, r.text) for i, r in before.items()], 5, 80, 100)
            assert rows.keys() == {key for key, _, component in found if key == component}
        elif name == "decontamination":
            leaked = {i for i, r in before.items() if any(leaks_by_hand(r.text, t) for t in bench if t[:40].lower() in r.text.lower())}
            assert leaked and rows.keys() == before.keys() - leaked
        else:
            assert rows.keys() == before.keys() and all(r.n_tokens == len(r.ids) for r in rows.values())
        docs, before = after, rows


def _mirrored(letters):
    """A word and its mirror image that polynomial hashes cannot tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(letters)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_collide_in_a_weak_hash_do_not_link(spark):
    one, other = _mirrored(2048)
    rows = [(1, one), (2, other), (3, f"{one} x y"), (4, f"{other} x y"), (5, f"{one.upper()} x  y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.grouped(df, 3, 90, 100).collect())) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 4), (5, 1, 3)]


def test_equal_hashes_of_all_words_change_no_group(spark, monkeypatch):
    from tablemend.llm import words

    pick = random.Random(4)
    texts = [" ".join(pick.choices("abcdefgh", k=pick.randrange(1, 9))) for _ in range(40)]
    texts += [t + " " + t for t in texts[:10]] + texts[:5] + ["a b c d e f g h i j k", "a b c d e f g h i j k l"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(map(tuple, jaccard.grouped(df, 2, 80, 100).collect()))
    monkeypatch.setattr(words, "strong_hash", lambda word: 7)
    assert sorted(map(tuple, jaccard.grouped(df, 2, 80, 100).collect())) == want


def test_long_texts_have_the_same_shingles(monkeypatch):
    text = " a B\tc\nc a b  c é\x0bz " * 20
    want = jaccard.digests_of(text, 3)
    monkeypatch.setattr(jaccard, "LONG", 5)
    monkeypatch.setattr(jaccard, "AT_ONCE", 4)
    assert jaccard.digests_of(text, 3).tolist() == want.tolist()
    for short in ("", "  ", "one", "one two", "one two three"):
        monkeypatch.setattr(jaccard, "LONG", 1 << 22)
        plain = jaccard.digests_of(short, 3)
        monkeypatch.setattr(jaccard, "LONG", 0)
        assert jaccard.digests_of(short, 3).tolist() == plain.tolist()
        assert len(plain) == bool(short.split())
