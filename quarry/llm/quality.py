"""Quality classifier: Bradley-Terry pairwise ranking.

Each text gets features of its own characters, words and lines. From labelled rows, pairs of a better and a worse text
are drawn, and the weights maximise the logistic likelihood that the better one wins, given the difference of the two
texts' features. So a text's strength is a weighted sum, and the cut between kept and rejected texts is the quantile
of the sample's strengths that separates the labels best. Scores are the strengths on the logistic scale, moved so
that the cut lies at the decision score.

The fit uses at most FIT_ROWS labelled rows (those of smallest hash, whole texts), which bounds what the driver gets:
that many short vectors. Scoring is one pass without a shuffle.

Defined results: null texts count as empty; empty texts have features of their own (all zero) and a score; labels that
are null are left out; repeated rows are scored each, and repeated labels count each; without labels of both kinds
nothing can be learnt and every score is 0.5 (nothing is rejected); an empty table gives an empty result; columns that
aren't named are ignored.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches

#: Bounds of the fit: labelled rows, and pairs drawn from them.
FIT_ROWS, PAIRS = 20_000, 60_000
#: Texts are accepted from this score.
DECISION = 0.3

#: Characters counted one by one, and classes of characters.
SIGNS = "!#$%&*|.,;:?\"'()[]{}<>/\\=+-_@~^`"
CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n")


def _classes() -> np.ndarray:
    """For each byte, which of the counted groups it is in."""
    out = np.zeros((256, len(SIGNS) + len(CLASSES) + 1))
    for i, group in enumerate([*SIGNS, *CLASSES]):
        for c in group:
            out[ord(c), i] = 1
    out[128:, -1] = 1
    return out


GROUPS = _classes()


def features(text: str) -> np.ndarray:
    """Shares of characters (and their roots), words and lines of a text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    shares = np.bincount(raw, minlength=256) @ GROUPS / max(1, len(raw))
    words = text.split()
    lines = text.split("\n")
    n = len(words)
    more = [
        np.log1p(len(raw)),
        np.log1p(n),
        min(40.0, len(raw) / max(1, n)),
        len(set(words)) / max(1, n),
        sum(map(operator.eq, words, words[1:])) / max(1, n),
        sum(map(str.isupper, words)) / max(1, n),
        sum(map(str.isalpha, words)) / max(1, n),
        1 - len(set(lines)) / len(lines),
        min(1.0, len(lines) / max(1, n)),
    ]
    return np.concatenate([shares, np.sqrt(shares), more, np.square(more[3:8])])


def matrix(texts: pa.Array) -> np.ndarray:
    return np.array([features(x.as_py() or "") for x in texts]).reshape(len(texts), -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights from pairs (rows of x) by Newton steps on the penalised logistic loss of feature differences."""
    d = x[better] - x[worse]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def cut(strength: np.ndarray, label: np.ndarray) -> float:
    """The quantile of the strengths at which the mean of the two labels' accuracies is largest."""
    at = np.quantile(strength, np.linspace(0.002, 0.998, 499))
    s1, s0 = np.sort(strength[label == 1]), np.sort(strength[label == 0])
    kept = 1 - np.searchsorted(s1, at) / len(s1)
    gone = np.searchsorted(s0, at) / len(s0)
    best = kept + gone
    return float(at[best >= best.max() - 1e-3].min())  # of equally good ones the lowest, which rejects least


def learn(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Model:
    ones, zeros = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(ones) or not len(zeros):
        k = x.shape[1] if x.ndim == 2 else 0
        return Model(np.zeros(k), np.ones(k), np.zeros(k), 0.0)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    w = bradley_terry(z, rng.choice(ones, pairs), rng.choice(zeros, pairs))
    strength = z @ w
    return Model(mean, scale, w, cut(strength, label) + float(np.log((1 - DECISION) / DECISION)))


def held_out(key: Column) -> Column:
    """Every fifth document by the checksum of its key is for evaluation only."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Learns from the labelled rows that aren't held out."""
    bound_batches(docs.sparkSession)
    own = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col(key))).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    chosen = own.orderBy(F.xxhash64("key"), "key", "label").limit(rows)

    @F.arrow_udf("array<double>")
    def vector(t: pa.Array) -> pa.Array:
        return pa.array(list(matrix(t)), pa.list_(pa.float64()))

    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key").select("label", vector("text").alias("x"), F.xxhash64("key").alias("h"))
    got = found.orderBy("h", "label").limit(rows).toPandas()
    return learn(np.array(got["x"].tolist()) if len(got) else np.zeros((0, len(features("")))), got["label"].to_numpy())


def score(model: Model, text: Column) -> Column:
    """The score of each text, 0 to 1."""

    @F.arrow_udf("double")
    def scored(t: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(t)) if model.weights.any() else np.full(len(t), 0.5))

    return scored(text)
