"""Secrets in texts: a keyword automaton first, patterns only where it hits, then the checksums inside the tokens.

One Aho-Corasick pass over a text gives the places where any keyword stands. A pattern of the keyword's kind is tried
at that place alone, so texts without keywords cost one pass. Kinds with a checksum or a decodable part are kept only
if it holds. Runs of hexadecimal digits have no keyword; there the places that are probed lie ``MIN_HEX`` apart, which
no long enough run can pass between.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_left

import ahocorasick
from pyspark.sql import DataFrame

from tablemend.llm.common import in_batches, ship, texts_of
from tablemend.llm.spans import Span, joined, sha256

ship(__name__)

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm", "jwt", "pem", "slack", "google", "stripe")
KINDS = BASE_KINDS + ADDED_KINDS
MIN_HEX = 32
MIN_ASSIGNED = 8
MIN_ACCESS = 16

#: Keywords in lower case, with the kind of pattern to try where they stand.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "eyj": "jwt",
    "-----begin": "pem",
    "xoxb-": "slack",
    "xoxp-": "slack",
    "xoxa-": "slack",
    "xoxs-": "slack",
    "aiza": "google",
    "sk_live_": "stripe",
    "rk_live_": "stripe",
}
PATTERNS = {
    "assign": re.compile(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "slack": re.compile(r"xox[bpas]-[0-9A-Za-z]+(?:-[0-9A-Za-z]+)+"),
    "google": re.compile(r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])"),
    "stripe": re.compile(r"[sr]k_live_[0-9A-Za-z]{24,}"),
}
#: A key in PEM form: its first line, what may stand up to its last line, and where last lines begin, overlapping or not.
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z ]{0,32}PRIVATE KEY)-----")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,-]*")
PEM_END = re.compile(r"(?=-----END ([A-Z ]{0,32}PRIVATE KEY)-----)")
JWT_PART = re.compile(r"[A-Za-z0-9_-]+")
HEX = re.compile(r"[0-9a-f]+")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_LETTERS = frozenset("0123456789abcdef")
TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def checksum62(body: str) -> str:
    """CRC-32 of a token's random part as six base-62 digits, as issuers append it."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _decodes(part: str) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, TypeError, RecursionError):  # not JSON, no object, or nested too deep for one
        return False


def holds(kind: str, match: re.Match) -> bool:
    """Whether a match meets the length, checksum or structure that its kind asks for."""
    if kind == "assign":
        return len(match[2]) >= MIN_ASSIGNED
    if kind == "access":
        return len(match[0]) >= MIN_ACCESS
    if kind in ("github", "npm"):
        return checksum62(match[1][:30]) == match[1][30:]
    return _decodes(match[1]) if kind == "jwt" else True


_AUTOMATON: list[ahocorasick.Automaton] = []


def automaton() -> ahocorasick.Automaton:
    """The automaton of the keywords, made once in a task."""
    if not _AUTOMATON:
        made = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            made.add_word(word, (len(word), kind))
        made.make_automaton()
        _AUTOMATON.append(made)
    return _AUTOMATON[0]


def lowered(text: str) -> str:
    """The text with small letters at the same places. Only one letter grows when made small; then A to Z alone change."""
    small = text.lower()
    return small if len(small) == len(text) else text.translate(TO_LOWER)


class PemKeys:
    """Where the keys in PEM form end. Last lines are listed once for a text, and each run that may be a body is read once."""

    def __init__(self, text: str):
        self._text = text
        self._ends: dict[str, list[int]] | None = None
        self._run = (0, 0)

    def end_of(self, start: int) -> int | None:
        """The end of the key that begins here: the nearest last line with its label, if only a body lies between."""
        begin = PEM_BEGIN.match(self._text, start)
        if not begin:
            return None
        if self._ends is None:
            self._ends = {}
            for end in PEM_END.finditer(self._text):
                self._ends.setdefault(end[1], []).append(end.start())
        body, label = begin.end(), begin[1]
        if not self._run[0] <= body < self._run[1]:
            self._run = body, PEM_BODY.match(self._text, body).end()
        ends = self._ends.get(label, [])
        at = bisect_left(ends, body)
        if at == len(ends) or ends[at] > self._run[1]:
            return None
        return ends[at] + len(f"-----END {label}-----")


def find(text: str) -> list[Span]:
    """All spans of a text, leftmost and not overlapping within a kind. A match that fails its check is passed over whole.

    The time is in proportion to the length of the text, whatever it holds.
    """
    spans: list[Span] = []
    passed = dict.fromkeys(KINDS, 0)
    hits = [(end - size + 1, kind) for end, (size, kind) in automaton().iter(lowered(text))]
    if len(hits) > 1:
        hits.sort()
    keys = PemKeys(text)
    for start, kind in hits:
        if start < passed[kind]:
            continue
        if kind == "pem":
            if end := keys.end_of(start):
                passed[kind] = end
                spans.append((start, end, kind))
            continue
        match = PATTERNS[kind].match(text, start)
        if not match:
            if kind == "jwt" and text.startswith("eyJ", start):
                # Every later start in the same run of letters comes to the same end of it.
                passed[kind] = JWT_PART.match(text, start).end()
            continue
        passed[kind] = match.end()
        if holds(kind, match):
            spans.append((start, match.end(), kind))
    return spans + _hex_runs(text)


def _hex_runs(text: str) -> list[Span]:
    spans, end = [], 0
    for i, letter in enumerate(text[MIN_HEX - 1 :: MIN_HEX]):
        if letter in HEX_LETTERS:
            at = (i + 1) * MIN_HEX - 1
            if at < end:
                continue
            start = at
            while start > 0 and text[start - 1] in HEX_LETTERS:
                start -= 1
            end = HEX.match(text, at).end()
            if end - start >= MIN_HEX:
                spans.append((start, end, "hex"))
    return spans


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, spans)``, the spans as ``(start, stop, kind)`` in code points, the stop exclusive, by start and kind.

    Every row gives a row, also repeated ones and those without a key. A null or empty text has no spans; texts are
    taken whole, whatever their length; other columns take no part.
    """
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        found = [sorted(find(t.as_py())) for t in batch.column(1)]
        return {
            "key": batch.column(0),
            "spans": [[{"start": s, "stop": e, "kind": k} for s, e, k in spans] for spans in found],
        }

    kind = frame.schema["key"].dataType.simpleString()
    schema = f"key {kind}, spans array<struct<start: int, stop: int, kind: string>>"
    return in_batches(frame, run, schema).withColumnRenamed("key", key)


def redact(documents: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``(key, text)`` with every finding replaced; findings that overlap are replaced once."""
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        return {"key": batch.column(0), "text": [_without(t.as_py(), mark) for t in batch.column(1)]}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(frame, run, f"key {kind}, text string").toDF(key, text)


def _without(text: str, mark: str) -> str:
    parts, at = [], 0
    for start, end, _ in sorted(find(text)):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_assign, n_access, n_hex, base_sha256, spans)``: the findings of ``scan``, counted and joined."""
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        columns = {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for value in batch.column(1):
            spans = find(value.as_py())
            base = [s for s in spans if s[2] in BASE_KINDS]
            for kind in BASE_KINDS:
                columns[f"n_{kind}"].append(sum(s[2] == kind for s in base))
            columns["base_sha256"].append(sha256(joined(base, KINDS)))
            columns["spans"].append(joined(spans, KINDS))
        return {"key": batch.column(0), **columns}

    kind = frame.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return in_batches(frame, run, schema).withColumnRenamed("key", key)
