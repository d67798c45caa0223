"""Language identification in two steps: the family, then one-versus-one within it.

Features are hashed counts of three-byte sequences of the lower-cased text (white space and
digits as one space each), square-rooted and scaled to length 1. Linear support vector
machines (squared hinge loss) tell each pair of families apart, then each pair of languages of
the family that wins; the most votes win, and the larger margin sum among equals.

Fitting takes about `sample` labelled rows in all, as many of each language as there are, at
most the same number of each, chosen by a hash of the id: that bound is the only one, and
whole texts count. Prediction reads the text alone.

Rows with NULL text or without a letter are `und` with score 0. NULL labels are not learnt
from; without any label all rows are `und`. Rows are independent; repeated ones repeat.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.text_arrays import LOWER, byte_set, text_slices

WIDTH = 2048
SAMPLE = 4000
UNDETERMINED = "und"
#: languages of one family; others are a family of their own
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi ur bn pa mr gu ne si",
    "semitic": "ar he am mt",
}
FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members.split()}

_LETTER = byte_set(bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)))
_FOLD = LOWER.copy()
_FOLD[list(range(0x30, 0x3A)) + list(range(0x21))] = 0x20

SCHEMA = "id long, lang_pred string, score double"
ARROW = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def family(language: str) -> str:
    return FAMILY_OF.get(language, language)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of WIDTH float32 for each text; of length 1, or 0 for texts of under three bytes."""
    n = len(offsets) - 1
    folded = _FOLD[data].astype(np.uint32)
    cells = np.zeros(n * WIDTH, dtype=np.float32)
    if len(folded) >= 3:
        grams = (folded[:-2] * np.uint32(0x9E3779B1)) ^ (folded[1:-1] * np.uint32(0x85EBCA77)) ^ (folded[2:] * np.uint32(0xC2B2AE3D))
        grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        slots = (grams >> np.uint32(32 - WIDTH.bit_length() + 1)).astype(np.int64)
        rows = np.repeat(np.arange(n), np.diff(offsets))
        same = rows[:-2] == rows[2:]
        cells = np.bincount((rows[:-2] * WIDTH + slots)[same], minlength=n * WIDTH).astype(np.float32)
    out = np.sqrt(cells).reshape(n, WIDTH)
    norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norms, 1e-9)


def lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    seen = np.concatenate([[0], np.cumsum(_LETTER[data])])[offsets]
    has = seen[1:] > seen[:-1]
    for r in np.flatnonzero(~has):
        has[r] = any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode(errors="ignore"))
    return has


def fit_svm(x: np.ndarray, y: np.ndarray, strength: float = 20.0, passes: int = 60) -> np.ndarray:
    """Weights, the bias last, that minimise |w|^2 / 2 + strength * mean squared hinge loss; y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = ahead = np.zeros(x.shape[1], np.float32)
    step = 1.0 / (1.0 + 4.0 * strength)
    for i in range(passes):  # accelerated gradient descent
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (ahead - 2 * strength * (x.T @ (share * slack * y)))
        ahead = new + i / (i + 3) * (new - w)
        w = new
    return w


@dataclass
class Votes:
    """One-versus-one machines over some classes."""

    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, x: np.ndarray, names: np.ndarray) -> Votes:
        out = cls(sorted(set(names.tolist())))
        own = []
        for a, b in itertools.combinations(range(len(out.classes)), 2):
            at = (names == out.classes[a]) | (names == out.classes[b])
            y = np.where(names[at] == out.classes[a], 1, -1).astype(np.float32)
            out.pairs.append((a, b))
            own.append(fit_svm(x[at], y))
        out.weights = np.array(own).T if own else None
        return out

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner and its mean probability against each other class."""
        n = len(x)
        if self.weights is None:
            return np.zeros(n, np.int64), np.ones(n)
        margins = x @ self.weights[:-1] + self.weights[-1]
        votes, sums, sure = (np.zeros((n, len(self.classes))) for _ in range(3))
        for k, (a, b) in enumerate(self.pairs):
            m = margins[:, k]
            chance = 1 / (1 + np.exp(-4.0 * m))
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            sums[:, a] += m
            sums[:, b] -= m
            sure[:, a] += chance
            sure[:, b] += 1 - chance
        best = np.argmax(votes + np.tanh(sums / len(self.pairs)) * 0.49, axis=1)
        return best, sure[np.arange(n), best] / (len(self.classes) - 1)


@dataclass
class Model:
    """The families' machines and those inside each family."""

    families: Votes
    inside: dict[str, Votes]

    @classmethod
    def fit(cls, x: np.ndarray, languages: np.ndarray) -> Model:
        families = np.array([family(v) for v in languages.tolist()], dtype=object)
        inside = {f: Votes.fit(x[families == f], languages[families == f]) for f in sorted(set(families.tolist()))}
        return cls(Votes.fit(x, families), inside)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        winner, sure = self.families.decide(x)
        names = np.empty(len(x), dtype=object)
        for k, name in enumerate(self.families.classes):
            at = np.flatnonzero(winner == k)
            if len(at):
                best, own = self.inside[name].decide(x[at])
                names[at] = np.array(self.inside[name].classes, dtype=object)[best]
                sure[at] *= own
        return names, np.clip(sure, 0.0, 1.0)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            found = features(data, offsets).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(first, end - first), pa.array([row.tobytes() for row in found], pa.binary())], ["lang", "x"]
            )


def remainder(id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % by


def fit(df: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Fits on a bounded, hash-chosen sample of the labelled rows of df."""
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.lit("fit"), F.col(id)).alias("h")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    counts = dict(rows.groupBy("lang").count().collect())
    if not counts:
        return None
    each = sample / len(counts)
    chance = F.lit(0.0)
    for name, n in counts.items():
        chance = F.when(F.col("lang") == name, F.lit(min(1.0, each / n))).otherwise(chance)
    chosen = rows.where((F.col("h") / F.lit(2.0**64) + 0.5) < chance).select("lang", "text")
    got = sorted((r["lang"], bytes(r["x"])) for r in chosen.mapInArrow(_feature_rows, "lang string, x binary").collect())
    if not got:
        return None
    x = np.array([np.frombuffer(v, np.float16) for _, v in got], dtype=np.float32)
    return Model.fit(x, np.array([name for name, _ in got], dtype=object))


def predictions(model: Model | None, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    names = np.full(len(offsets) - 1, UNDETERMINED, dtype=object)
    scores = np.zeros(len(names))
    at = np.flatnonzero(lettered(data, offsets)) if model else []
    if len(at):
        found, sure = model.predict(features(data, offsets))
        names[at], scores[at] = found[at], sure[at]
    return names, scores


def _predictor(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                names, scores = predictions(model, data, offsets)
                own = batch.column("id").slice(first, end - first)
                yield pa.RecordBatch.from_arrays([own, pa.array(names, pa.string()), pa.array(scores)], schema=ARROW)

    return predict


def identify(df: DataFrame, model: Model | None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) for each row."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_predictor(model), SCHEMA).withColumnRenamed("id", id)


def keep(df: DataFrame, model: Model | None, least_score: float, text: str = "text") -> DataFrame:
    """The rows of df, unchanged, whose language is known with at least this score."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(text)):
                names, scores = predictions(model, data, offsets)
                good = (names != UNDETERMINED) & (scores >= least_score)
                yield batch.slice(first, end - first).filter(pa.array(good))

    return df.mapInArrow(chosen, df.schema)


def language_report(df: DataFrame) -> DataFrame:
    """Learns from the rows whose remainder by 5 is not 0 and predicts all."""
    model = fit(df.where(remainder(F.col("doc_id"), 5) != 0))
    return identify(df, model).select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
