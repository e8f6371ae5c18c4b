"""Findings in a text as spans, and the digest columns that the queries derive from them."""

from __future__ import annotations

import hashlib

from tablemend.llm.common import ship

ship(__name__)

Span = tuple[int, int, str]


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by kind in the order listed, joined by commas."""
    order = {kind: i for i, kind in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], order[x[2]], x[1])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
