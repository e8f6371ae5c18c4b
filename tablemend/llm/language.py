"""Language identification in two steps: the family first, then one-versus-one machines within it.

A text is a histogram of hashed byte trigrams of its letters, in small letters, on the unit sphere (square roots of the
shares). Linear support vector machines, one against the rest, choose the language family; within a family, one machine
for every pair of its languages votes. Close languages are so told apart by weights that no distant language has a say in.

The machines are fitted in the driver on about ``per_language`` documents of every language, picked by a hash of their
key; texts are always profiled whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import in_batches, remainder, ship, texts_of

ship(__name__)

UNKNOWN = "und"
PER_LANGUAGE = 1000
DIMENSIONS = 2048
EPOCHS = 12
COST = 20.0

#: Language codes by family. A code that is not listed makes a family of its own.
FAMILIES = {
    "germanic": "en de nl af da sv no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi ur bn pa gu mr ne si",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Bytes that are no letters become spaces; other bytes stay.
LETTER = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], dtype=np.uint32)


def family_of(language: str) -> str:
    return FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], f"only {language}")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def profile(text: str) -> np.ndarray:
    """Square roots of the shares of hashed trigrams."""
    b = LETTER[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    b = b[(b != 32) | (np.roll(b, 1) != 32)]
    if len(b) < 3:
        return np.zeros(DIMENSIONS, dtype=np.float32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    slot = (code * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    return np.sqrt(np.bincount(slot, minlength=DIMENSIONS) / len(slot)).astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, seed: int = 11) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge loss), by coordinate descent on the dual."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float32)
    square = (x * x).sum(1) + 0.5 / COST
    alpha, w, rng = np.zeros(len(x)), np.zeros(x.shape[1], dtype=np.float32), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(x)):
            slope = y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / COST
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


@dataclass(frozen=True)
class Model:
    """Families with their machines; by family, its languages and a machine for every pair of them."""

    families: tuple[str, ...]
    family_weights: np.ndarray
    languages: dict[str, tuple[str, ...]]
    pair_weights: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """A language and a score for every profile."""
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
        margins = x @ self.family_weights.T
        best = margins.argmax(1)
        sure = np.ones(len(x)) if len(self.families) == 1 else _sure(margins[np.arange(len(x)), best])
        names, scores = np.empty(len(x), dtype=object), np.zeros(len(x))
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            if len(rows):
                names[rows], within = self._within(self.languages[family], x[rows])
                scores[rows] = sure[rows] * within
        return list(names), scores

    def _within(self, languages: tuple[str, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(languages) == 1:
            return np.full(len(x), languages[0], dtype=object), np.ones(len(x))
        votes = np.zeros((len(x), len(languages)))
        for i, j in combinations(range(len(languages)), 2):
            first = _sure(x @ self.pair_weights[languages[i], languages[j]])
            votes[:, i] += (first >= 0.5) + first / len(languages) ** 2
            votes[:, j] += (first < 0.5) + (1 - first) / len(languages) ** 2
        best = votes.argmax(1)
        top = votes[np.arange(len(x)), best] / ((len(languages) - 1) * (1 + 1 / len(languages) ** 2))
        return np.array(languages, dtype=object)[best], np.clip(top, 0, 1)


def _sure(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))


def fit(x: np.ndarray, languages: list[str]) -> Model:
    """All machines, from profiles and their languages."""
    labels = np.array(languages, dtype=object)
    members: dict[str, list[str]] = {}
    for language in sorted(set(languages)):
        members.setdefault(family_of(language), []).append(language)
    families = tuple(sorted(members))
    of = np.array([family_of(v) for v in languages], dtype=object)
    width = x.shape[1] + 1
    if len(families) == 2:
        w = machine(x, np.where(of == families[0], 1.0, -1.0))
        rest = np.vstack([w, -w])
    elif len(families) > 2:
        rest = np.vstack([machine(x, np.where(of == f, 1.0, -1.0)) for f in families])
    else:
        rest = np.zeros((len(families), width), dtype=np.float32)
    pairs = {}
    for codes in members.values():
        for a, b in combinations(codes, 2):
            rows = (labels == a) | (labels == b)
            pairs[a, b] = machine(x[rows], np.where(labels[rows] == a, 1.0, -1.0))
    return Model(families, rest, {f: tuple(m) for f, m in members.items()}, pairs)


def train(
    documents: DataFrame,
    learn_from: Column | None = None,
    per_language: int = PER_LANGUAGE,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Fit a model on about ``per_language`` rows of every language (by a hash of key and text), all if there are fewer.

    Rows without a language, or whose text has no letter, are not learnt from.
    """
    usable = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if learn_from is not None:
        usable = usable.where(learn_from)
    sizes = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    if not sizes:
        return fit(np.zeros((0, DIMENSIONS), dtype=np.float32), [])
    grain = 1 << 30
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key), F.col(text)), F.lit(grain))
    picked = F.lit(False)
    for name, n in sizes.items():
        picked = picked | ((F.col(lang) == F.lit(name)) & (place < F.lit(min(grain, grain * per_language // n))))

    def run(batch):
        texts, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = [(profile(t).tobytes(), n) for t, n in zip(texts, names) if has_letter(t)]
        return {"x": pa.array([r[0] for r in rows], pa.binary()), "lang": pa.array([r[1] for r in rows], pa.string())}

    frame = usable.where(picked).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = sorted((r[1], bytes(r[0])) for r in in_batches(frame, run, "x binary, lang string").collect())
    x = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.float32).reshape(-1, DIMENSIONS)
    return fit(x, [r[0] for r in rows])


def identify(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score)`` of every row; ``und`` with score 0 for a text that is null or has no letter.

    Repeated rows and null keys give a row each; texts are read whole; other columns take no part.
    """
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        texts = batch.column(1).to_pylist()
        known = np.array([has_letter(t) for t in texts], dtype=bool)
        names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
        if known.any():
            x = np.vstack([profile(t) for t, ok in zip(texts, known) if ok])
            predicted, sure = model.predict(x)
            names[known], scores[known] = predicted, sure
        return {"key": batch.column(0), "lang_pred": list(names), "score": scores}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(frame, run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def identify_held_out(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``; a quarter of the documents, by crc32 of the key, is never learnt from."""
    model = train(documents, F.coalesce(remainder("doc_id", 4) != 2, F.lit(True)), per_language)
    found = identify(documents, model)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")
