"""Personal data, secrets, encoding, quality and language against brute force, the library, and held-out labels."""

import base64
import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablemend.llm import boosting, bpe, language, line_dedup, pii, quality, secret_scan
from tablemend.llm.queries import QUERIES

BPE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


def joined(spans, kinds):
    spans = sorted(spans, key=lambda s: (s[0], kinds.index(s[2])))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- personal data ------------------------------------------------------------


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def pii_by_hand(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


PII_PARTS = [
    "a@b.c", "x.y", "@", ".", "..", "-", "+", "1", "22", "255", "256", "4111111111111111", "4952935900253052", " ",
    "+1 (017) 555-7713", "10.0.0.1", "é", "😀", "a_b", "mail4", "example.com", "(", ")", "0", "\n", "+49", "123 456", "%",
]


def test_pii_base_spans(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(PII_PARTS) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    texts += [None, "", "1" * 20_000, "a" * 60_000 + "@b", "1 " * 9_000 + "x", "1." * 20_000, "a@b." * 2_000, "+1(" + "(" * 20_000]
    rows = [(i if i % 7 else i // 2, t, 1, "x") for i, t in enumerate(texts)] + [(None, "10.0.0.1 a@b.c", 2, "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, kind string")
    kinds = list(pii.BASE_KINDS)
    want = []
    for key, text, *_ in rows:
        spans = pii_by_hand(text)
        want.append((key, *(sum(s[2] == k for s in spans) for k in kinds), sha(joined(spans, kinds))))
    got = [tuple(r[:6]) for r in pii.digests(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_pii_adds_spans_that_look_alike_and_nothing_else(spark):
    numbers = ["4111111111111111", "4952935900253052", "5500005555555559"]
    rows = [(i, f"please note card {numbers[i % 3]} and page {i % 50} here") for i in range(900)]
    rows += [(900, "card 4111111111111112 end"), (901, "page 17 of chapter 3"), (902, "no number at all")]
    found = {r.doc_id: r for r in pii.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[900].n_card == 0 and found[900].spans == "number_like:5:21"
    assert found[901].spans == found[902].spans == ""
    assert found[0].spans == "card:17:33"


@pytest.mark.parametrize("copies", [1, 20])
def test_pii_generators_add_spans_at_every_size(spark, copies):
    names = ["ann", "bob", "cleo", "dora", "emil", "fritz", "gina", "hugo", "ida", "jan", "kurt", "lea"]
    texts = [f"write to {n}@{n}site.org today" for n in names] + ["the price @home, a list@once and so@on"] * 4
    texts = texts * copies + [f"card 4111111111111111 and page {10 + i % 50} here" for i in range(300)]
    texts += ["write to max@müller.org today", "not a thing@all today"]
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in pii.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[len(rows) - 2].n_email == 0 and found[len(rows) - 2].spans == "mail_like:9:23"
    assert found[len(rows) - 1].spans == ""


def test_pii_finds_obfuscated_addresses(spark):
    names = ["ann", "bob", "cleo", "dora", "emil", "fritz", "gina", "hugo", "ida", "jan", "kurt", "lea"]
    texts = [f"write to {n}@{n}site.org today" for n in names * 10] + ["the price @home, a list@once and so@on"] * 40
    hidden = ["john (at) example.com", "john[at]example.com", "john(at) example.com"]
    texts += [f"card 4111111111111111 and page {10 + i % 50} here" for i in range(300)]
    texts += [f"write to {h} today" for h in hidden] + ["meet (at) noon today"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [r.spans for r in pii.digests(df).orderBy("doc_id").collect()][-6:]
    assert found == [f"mail_like:9:{9 + len(h)}" for h in hidden] + [""] * 3
    redacted = [r.text for r in pii.redact(df).orderBy("doc_id").collect()][-6:]
    assert redacted == ["write to [PII] today"] * 3 + ["meet (at) noon today"] * 3


def test_pii_thresholds():
    many = [("number_like", 50, 500, 490), ("number_like", 10, 500, 20), ("mail_like", 50, 2, 2), ("mail_like", 10, 2, 0)]
    assert pii.thresholds(many) == {"mail_like": 50, "number_like": 50, "dotted_like": 50}
    bad = [("dotted_like", 50, 500, 300), ("dotted_like", 70, 1, 0)]
    assert pii.thresholds(many + bad) == {"number_like": 50}
    assert pii.thresholds(many + [("dotted_like", 50, 40, 10)])["number_like"] == 50
    assert "dotted_like" not in pii.thresholds(many + [("dotted_like", 50, 40, 10)])
    assert pii.thresholds([]) == {}


def test_pii_of_an_empty_table_and_redaction(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.digests(empty).count() == 0
    df = spark.createDataFrame([(1, "é a@b.c, 10.0.0.1!"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, pii.redact(df).collect())) == [(1, "é [PII], [PII]!"), (2, "")]


def test_trees_score_alike_as_sql(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (400, 3)).astype(float)
    y = (x[:, 0] > 2) ^ (x[:, 1] > 3)
    trees = boosting.fit(x, y)
    assert ((trees.score(x) > 0) == y).mean() > 0.98
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = [r[0] for r in df.select(trees.column([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert np.allclose(sorted(got), sorted(trees.score(x)))
    assert boosting.fit(x, np.ones(400, bool)) is None
    assert boosting.threshold_for(np.array([3.0, 2, 1]), np.array([True, True, False]), 0.6, 1) == 2.0
    assert boosting.threshold_for(np.array([]), np.array([], bool), 0.6, 1) == float("inf")


# --- secrets ------------------------------------------------------------------


def secrets_by_hand(text):
    out, text = [], text or ""
    pattern = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out += [(m.start(), m.end(), "assign") for m in re.finditer(pattern, text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]


SECRET_PARTS = [
    "password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "AKIA", '="', ": ", "\"'=", "=", "abcdef0123456789",
    "deadbeef" * 4, "ABCDEFGH12345678", " ", "İ", "K", "é", "x", ".", "token=secret=abcdefgh", "a" * 31, "f", "-", "\n",
]


def test_secret_base_spans(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(SECRET_PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += [None, "", "f" * 100_000, "token=" * 20_000]
    df = spark.createDataFrame([(i // 2, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    kinds = list(secret_scan.BASE_KINDS)
    want = []
    for i, text in enumerate(texts):
        spans = secrets_by_hand(text)
        want.append((i // 2, *(sum(s[2] == k for s in spans) for k in kinds), sha(joined(spans, kinds))))
    assert sorted(tuple(r[:5]) for r in secret_scan.digests(df).collect()) == sorted(want)


def test_secret_checksums_and_redaction(spark):
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good, bad = f"ghp_{body}{secret_scan.checksum62(body)}", f"ghp_{body}000000"
    assert secret_scan.find(f"x {good} {bad}") == [(2, 42, "github")]
    df = spark.createDataFrame([(1, f"x {good}."), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, secret_scan.redact(df).collect())) == [(1, "x [SECRET]."), (2, "")]
    assert secret_scan.scan(df.limit(0)).count() == 0


# --- encoding -----------------------------------------------------------------


def test_bpe_equals_the_library(spark):
    tokenizer, coder = Tokenizer.from_file(BPE), bpe.Coder(bpe.load_vocabulary(BPE))
    rng = random.Random(1)
    letters = [chr(x) for x in range(0x250)] + list("  \n\n\t'sst  the\x85\xa0 日本語😀é") + ["<|endoftext|>", "'re", "​"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 5000, "thethat" * 900, "é" * 2000, "".join(rng.choice("etaoin") for _ in range(9000)), " " * 3000]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids
        assert coder.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip(spark):
    rows = [(1, "the thing"), (1, "the thing"), (None, "é\n"), (2, None), (3, "")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, key string, ids int")
    encoded = bpe.encode(df, BPE)
    assert sorted(map(str, map(tuple, bpe.decode(encoded, BPE).collect()))) == sorted(str((k, t or "")) for k, t in rows)
    found = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe.digests(df, BPE).collect()}
    assert (2, 0, sha("")) in found and (None, 2, sha("é\n")) in found
    assert bpe.encode(df.limit(0), BPE).count() == 0


# --- quality and language -----------------------------------------------------


def test_quality_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op5_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98


def test_quality_threshold_covers_all_labels(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join("x" * int(n) for n in rng.integers(1, 12, rng.integers(3, 60))) for _ in range(600)]
    good = [int(len(t) + rng.normal() * 60 > 130) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int").where("doc_id % 10 != 0")
    ranking = quality.train(docs, labels, max_labelled=40)
    raw = ranking.raw(np.array([quality.features(t) for i, t in enumerate(texts) if i % 10]))
    assert sum(raw > ranking.threshold) == sum(g for i, g in enumerate(good) if i % 10)


def test_quality_without_two_sorts_of_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, ""), (2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for usable in (labels, labels.limit(0)):
        rows = quality.score_held_out(docs, usable).collect()
        assert len(rows) == 4 and all(r.score == pytest.approx(0.5) and r.predicted == 1 for r in rows)
    assert quality.score_held_out(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, quality.train(docs, labels)).count() == 4


def test_language_on_held_out_documents(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_language"](spark, SF).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_of_odd_texts(spark):
    rows = [(i, f"the {i} and of", "en", 1) for i in range(30)] + [(100 + i, f"la {i} de los", "xx", 1) for i in range(30)]
    rows += [(200, None, "en", 1), (201, "", "en", 1), (202, "12 !", None, 1), (None, "the and", None, 1), (203, "the and of", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    found = {r.doc_id: r for r in language.identify_held_out(df).collect()}
    assert len(found) == len(rows)
    assert [found[i].lang_pred for i in (200, 201, 202, 203, None)] == ["und", "und", "und", "en", "en"]
    assert found[200].score == 0 and language.identify_held_out(df.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identify_held_out(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.family_of("de-AT") == "germanic" and language.family_of("xx") == "only xx"


# --- hostile texts --------------------------------------------------------------


def _in_seconds(limit, run):
    start = time.perf_counter()
    run()
    assert time.perf_counter() - start < limit


MB = 1 << 20
HOSTILE = {
    "jwt": "eyJ" * (MB // 3),
    "jwt_parts": "eyJa." * (MB // 5),
    "pem": "-----BEGIN RSA PRIVATE KEY-----\n" * (MB // 32),
    "pem_labels": "".join(f"-----BEGIN {chr(65 + i % 26)}{chr(65 + i // 26 % 26)}{chr(65 + i // 676)} PRIVATE KEY-----" for i in range(17000)),
    "pem_ends": "-----BEGIN PRIVATE KEY-----" * 20000 + "!" + "-----END PRIVATE KEY-----" * 20000,
    "assign": "password " * (MB // 9),
    "assign_blanks": "token" + " " * MB,
    "slack": "xoxb-" * (MB // 5),
    "hex": "0123456789abcdef" * (MB // 16),
    "access": "AKIA" * (MB // 4),
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_secrets_in_time(name):
    _in_seconds(10, lambda: secret_scan.find(HOSTILE[name]))


def test_secret_in_deep_json():
    deep = base64.urlsafe_b64encode(('{"a":' + "[" * 200_000).encode()).decode().rstrip("=")
    good = base64.urlsafe_b64encode(b'{"alg":"HS256"}').decode().rstrip("=")
    assert secret_scan.find(f"{deep}.eyJ9.x {good}.eyJ9.x") == [(len(deep) + 8, len(deep) + 8 + len(good) + 7, "jwt")]


def test_pem_keys_equal_one_pattern():
    whole = re.compile(r"-----BEGIN ([A-Z ]{0,32}PRIVATE KEY)-----[A-Za-z0-9+/=\s:,-]*?-----END \1-----")
    pick = random.Random(2)
    pieces = ["-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----", "-----BEGIN A PRIVATE KEY-----", "-----END A PRIVATE KEY-----",
              "abc+/=", "\n", "!", "-----", "END PRIVATE KEY-----", "-----BEGIN "]
    for _ in range(3000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randrange(14)))
        want = [m.span() for m in whole.finditer(text)]
        assert [(s, e) for s, e, kind in sorted(secret_scan.find(text)) if kind == "pem"] == want, text


def test_jwt_equals_one_pattern():
    whole = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
    good = base64.urlsafe_b64encode(b'{"alg":1}').decode().rstrip("=")
    pick = random.Random(5)
    for _ in range(3000):
        text = "".join(pick.choice([good, "eyJ", "EYJ", ".", "a", " ", "-"]) for _ in range(pick.randrange(12)))
        want = [m.span() for m in whole.finditer(text) if secret_scan._decodes(m[1])]
        assert [(s, e) for s, e, kind in sorted(secret_scan.find(text)) if kind == "jwt"] == want, text


def test_pages_in_time(spark):
    pages = ["<" * MB, "<script>" * (MB // 8), "<!--" * (MB // 4), "<style " * (MB // 7), "<p " * (MB // 3), "<div/" * (MB // 5)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id int, html string")
    _in_seconds(20, lambda: df.select(F.length(line_dedup.lines_of_html(F.col("html")))).collect())


def test_what_is_not_closed(spark):
    pages = {"a<script>b": "a", "a<script>b<script>c</script>d": "ad", "a<!-- b": "a", "a<b c": "a<b c", "x < y <i>z</i>": "x < y z", "1<p a='2'>3": "1\n3"}
    df = spark.createDataFrame(list(pages.items()), "html string, want string")
    assert [r[0] for r in df.select(line_dedup.lines_of_html(F.col("html"))).collect()] == list(pages.values())
