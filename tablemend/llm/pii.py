"""Personal data in texts: generators with high recall, boosted trees on format and context, calibrated thresholds.

Four base patterns with checks (e-mail addresses, IP addresses, card and phone numbers) always count. Three generators
propose further spans, which may overlap the base ones: anything around an at sign, numbers in groups, and dotted
numbers. A candidate that holds a valid base match is a positive example, any other a negative one; an obfuscated at sign
is written out first, so "john (at) example.com" counts as the address that it stands for. Trees are boosted
on the form of the candidate and the words and letters beside it, never on the checks themselves. On a third of all
candidates, which the trees never see, every generator gets the lowest threshold that keeps ``PRECISION``; candidates
above it are added.

Only DataFrame functions touch the data. Texts are cut by the patterns, so the place of a match is the running sum of
the lengths before it. The trees are fitted in the driver on at most ``SAMPLE`` candidates of each generator, all if
there are fewer, and scored as SQL; the thresholds come from counts by generator and score.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm import boosting
from tablemend.llm.common import bounded_sample, numbered, stored

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("mail_like", "number_like", "dotted_like")
KINDS = BASE_KINDS + ADDED_KINDS
SAMPLE = 20_000
PRECISION = 0.9
#: The precision of all generators together counts as so many rows of each. Many rows of its own outweigh them.
PRIOR_ROWS = 10
#: Scores are counted in steps of a 64th.
STEPS = 64
BEFORE, AFTER = 24, 8

#: An at sign in disguise, apart from the spaces around it.
HIDDEN_AT = r"[(\[]at[)\]]"
#: The patterns, with possessive repeats where nothing can be given back: a long run costs one pass and no stack.
#: A match that starts inside a run of its first letters would have started at the run's head, or at the last match's end.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "mail_like": rf"(?:(?<![^\s@|,;<>])|(?<={HIDDEN_AT})|\G)(?:(?!{HIDDEN_AT})[^\s@|,;<>])++(?:@|\x20?{HIDDEN_AT}\x20?)[^\s@|,;<>]++",
    "number_like": r"(?<![0-9])[+(]?[0-9](?:[\x20()./+-]{0,2}+[0-9])++",
    "dotted_like": r"(?:(?<![0-9])|\G)[0-9]++(?:[.:_][0-9]++){2,}+",
}
#: Words before a number that speak for or against personal data.
CUES_FOR = r"(?i)\b(?:tel|phone|call|fax|mobile|card|visa|credit|account|iban|ssn|passport|host|server|mail|contact)\b"
CUES_AGAINST = r"(?i)\b(?:version|page|order|item|price|isbn|chapter|section|year|figure|table|no|nr)\b"
FEATURES = (
    "digits", "letters", "size", "groups", "longest", "at", "plus", "brackets", "dots", "spaces", "left", "right", "cue"
)


def _hits(text: Column, kind: str) -> Column:
    """All matches of a kind with the length of the text between them, and what stands before and after."""
    pattern = PATTERNS[kind]
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(hits)
    return F.transform(
        F.arrays_zip(
            F.slice(gaps, F.lit(1), n).alias("gap"), hits.alias("hit"), F.slice(gaps, F.lit(2), n).alias("next")
        ),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(x["gap"]).alias("gap"),
            x["hit"].alias("hit"),
            F.right(x["gap"], F.lit(BEFORE)).alias("before"),
            F.left(x["next"], F.lit(AFTER)).alias("after"),
        ),
    )


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a number fits."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    """The check of a base kind."""
    digits = _digits(hit)
    if kind == "ip":
        parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits) <= 19, _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _proven(hit: Column) -> Column:
    """Whether a candidate holds a valid match of a base kind."""

    def holds(kind: str) -> Column:
        return F.exists(F.regexp_extract_all(hit, F.lit(PATTERNS[kind]), F.lit(0)), lambda m: _valid(kind, m))

    return reduce(lambda a, b: a | b, map(holds, BASE_KINDS))


def _written_out(kind: Column, hit: Column) -> Column:
    """The candidate with its obfuscated at sign undone."""
    return F.when(kind == "mail_like", F.regexp_replace(hit, rf"\x20?{HIDDEN_AT}\x20?", "@")).otherwise(hit)


def _letter_kind(letter: Column) -> Column:
    """0 for nothing or white space, 1 for a letter, 2 for a digit, 3 for anything else."""
    return (
        F.when(letter.rlike(r"^\s*$"), 0).when(letter.rlike(r"^\p{L}$"), 1).when(letter.rlike("^[0-9]$"), 2).otherwise(3)
    )


def features() -> list[Column]:
    """Numbers that describe the form of a candidate, written out, and its surroundings."""
    hit = F.col("plain")
    groups = F.split(F.regexp_replace(hit, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+")
    count = lambda letters: F.length(hit) - F.length(F.translate(hit, letters, ""))
    cue = F.when(F.col("before").rlike(CUES_FOR), 1).when(F.col("before").rlike(CUES_AGAINST), -1).otherwise(0)
    columns = (
        F.length(_digits(hit)),
        F.length(F.regexp_replace(hit, r"\P{L}", "")),
        F.length(hit),
        F.size(groups),
        F.array_max(F.transform(groups, F.length)),
        count("@"),
        hit.startswith("+").cast("int"),
        count("()[]"),
        count("."),
        count(" "),
        _letter_kind(F.right("before", F.lit(1))),
        _letter_kind(F.left("after", F.lit(1))),
        cue,
    )
    return [c.cast("double").alias(name) for c, name in zip(columns, FEATURES)]


def _matches(frame: DataFrame) -> DataFrame:
    """A row for every match of every kind: ``(row, kind, i, gap, hit, before, after)``. Texts without digit or at sign are spared."""
    text = F.col("text")
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,hit:string,before:string,after:string>>")
    digit = text.rlike("[0-9]")
    needs = {
        "email": text.contains("@"),
        "mail_like": text.contains("@") | text.contains("at)") | text.contains("at]"),
        "phone": text.contains("+"),
    }
    found = F.concat(*(F.when(needs.get(k, digit), _hits(text, k)).otherwise(none) for k in KINDS))
    return frame.where(digit | needs["mail_like"]).select("row", F.explode(found).alias("m")).select("row", "m.*")


def _placed(matches: DataFrame) -> DataFrame:
    """Matches with their place: the text and the matches before them, in code points."""
    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap").cast("long") + F.length("hit")).over(order)
    return matches.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("hit"))


def _step(trees: boosting.Trees) -> Column:
    return F.floor(trees.column([F.col(name) for name in FEATURES]) * STEPS).cast("long")


def thresholds(counts: list[tuple[str, int, int, int]]) -> dict[str, int]:
    """The lowest step for each generator at which its precision is kept, from ``(kind, step, rows, proven rows)``.

    Precision is that of its rows at or above the step, and of ``PRIOR_ROWS`` more that are as good as the rows of all
    generators there. A generator of few rows, or none, so follows the others, one of many its own. It has no threshold,
    and adds nothing, only if the precision is kept at no step.
    """
    steps = np.array(sorted({c[1] for c in counts}, reverse=True), dtype=np.int64)
    rows, right = (np.zeros((len(ADDED_KINDS), len(steps))) for _ in range(2))
    for kind, step, n, proven in counts:
        at = ADDED_KINDS.index(kind), len(steps) - 1 - np.searchsorted(steps[::-1], step)
        rows[at] += n
        right[at] += proven
    rows, right = rows.cumsum(1), right.cumsum(1)
    shared = right.sum(0) / np.maximum(1, rows.sum(0))
    kept = right + PRIOR_ROWS * shared >= PRECISION * (rows + PRIOR_ROWS) - 1e-9
    return {k: int(steps[kept[i]][-1]) for i, k in enumerate(ADDED_KINDS) if kept[i].any()}


def train(candidates: DataFrame, sample: int = SAMPLE) -> tuple[boosting.Trees | None, dict[str, int]]:
    """Trees and a threshold for each generator, in steps of the score, from ``(row, i, kind, proven, features)``.

    A third of the candidates by hash is held out, and all of it counts for the thresholds. The trees learn from at most
    ``sample`` of the others of each generator. Without both sorts among them there is nothing to learn.
    """
    placed = candidates.withColumn("place", F.xxhash64("row", "kind", "i"))
    held = F.pmod("place", F.lit(3)) == 0
    of_kind = [bounded_sample(placed.where(~held & (F.col("kind") == k)), "place", sample) for k in ADDED_KINDS]
    rows = sorted(reduce(DataFrame.unionAll, of_kind).collect(), key=lambda r: r["place"])
    x = np.array([[r[name] for name in FEATURES] for r in rows]).reshape(len(rows), len(FEATURES))
    trees = boosting.fit(x, np.array([r["proven"] for r in rows], dtype=bool))
    if trees is None:
        return None, {}
    counted = placed.where(held).groupBy("kind", _step(trees).alias("step"))
    counts = counted.agg(F.count("*").alias("n"), F.sum(F.col("proven").cast("long")).alias("right")).collect()
    return trees, thresholds([(r["kind"], r["step"], r["n"], r["right"]) for r in counts])


def find(documents: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """``(row, kind, start, stop)`` of every span, the stop exclusive, in code points; and ``(key, row)`` of all documents.

    Base matches are leftmost and do not overlap within a kind; one that fails its check is dropped and its letters are
    not tried again. Null and empty texts have no spans. Rows that share a key, or have none, are documents each. Other
    columns take no part.
    """
    frame = numbered(documents, key, text)
    placed = stored(_placed(_matches(frame)))
    base = placed.where(
        reduce(lambda a, b: a | b, ((F.col("kind") == k) & _valid(k, F.col("hit")) for k in BASE_KINDS))
    ).select("row", "kind", "start", "stop")
    candidates = stored(
        placed.where(F.col("kind").isin(*ADDED_KINDS)).select(
            "row", "kind", "i", "start", "stop", "hit", "before", "after", _written_out(F.col("kind"), F.col("hit")).alias("plain")
        )
        .select(
            "row", "kind", "i", "start", "stop", _proven(F.col("plain")).alias("proven"),
            (F.col("plain") != F.col("hit")).alias("hidden"), *features()
        )
    )
    trees, limits = train(candidates, sample)
    if trees is not None and limits:
        limit = reduce(lambda c, k: c.when(F.col("kind") == k, limits[k]), limits, F)
        added = candidates.where(~F.col("proven") | F.col("hidden")).where(_step(trees) >= limit)
        base = base.unionAll(added.select("row", "kind", "start", "stop"))
    return base, frame.select("key", "row")


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of what ``find`` finds."""
    spans, rows = find(documents, key, text)
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    one = F.struct(F.col("start"), rank.alias("rank"), F.col("stop"), F.concat_ws(":", "kind", "start", "stop").alias("said"))
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    joined = rows.join(by_row, "row", "left")
    ours = F.filter("spans", lambda s: s["rank"] <= len(BASE_KINDS))
    said = lambda c: F.coalesce(F.array_join(F.transform(c, lambda s: s["said"]), ","), F.lit(""))
    number = lambda i: F.coalesce(F.size(F.filter("spans", lambda s: s["rank"] == i)), F.lit(0)).cast("long")
    return joined.select(
        F.col("key").alias(key),
        *(F.when(F.col("spans").isNull(), 0).otherwise(number(i + 1)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)),
        F.sha2(said(ours), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[PII]") -> DataFrame:
    """``(key, text)`` with every span replaced; spans that overlap are replaced together."""
    spans, _ = find(documents, key, text)
    frame = numbered(documents, key, text)
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        kept = F.col("text").substr(done["at"].cast("int") + 1, F.greatest(F.lit(0), span["start"] - done["at"]).cast("int"))
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"),
            F.when(fresh, F.concat(done["text"], kept, F.lit(mark))).otherwise(done["text"]).alias("text"),
        )

    joined = frame.join(by_row, "row", "left")
    done = F.aggregate("spans", start, step)
    rest = F.concat(done["text"], F.col("text").substr(done["at"].cast("int") + 1, F.length("text")))
    return joined.select(F.col("key").alias(key), F.when(F.col("spans").isNull(), F.col("text")).otherwise(rest).alias(text))
