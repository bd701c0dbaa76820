"""Quality by Bradley-Terry ranking: scores learned from preference pairs, cut at a quantile.

Every document is described by fixed text statistics. A preference pair is a good and a bad labelled
document; the model says that the good one wins with probability sigmoid(s(good) - s(bad)) for a linear
score s, so it is a logistic regression without intercept on differences of features. The decision lies
at the quantile of the training scores that the share of bad documents names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from casegrid.llm.common import with_text
from casegrid.llm.labelled import fit_logistic, labelled, sigmoid

#: At most so many labelled rows, those with the smallest id hash, and so many pairs among them.
SAMPLE_ROWS, PAIRS = 20_000, 60_000


def _byte_kinds() -> np.ndarray:
    """Groups of bytes: 0 small letter, 1 capital, 2 digit, 3 non-ASCII, 4 blank, 5 line feed, then single marks."""
    kinds = np.full(256, 4, np.uint8)
    kinds[ord("a") : ord("z") + 1], kinds[ord("A") : ord("Z") + 1], kinds[ord("0") : ord("9") + 1] = 0, 1, 2
    kinds[0x80:], kinds[ord("\n")] = 3, 5
    marks = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    kinds[marks] = 6 + np.arange(len(marks))
    return kinds


_KINDS = _byte_kinds()
N_KINDS = int(_KINDS.max()) + 1
#: Kinds for pairs of neighbours: all marks but comma and full stop count as one.
_COARSE = np.where(np.arange(N_KINDS) < 6, np.arange(N_KINDS), 6).astype(np.uint8)
_COARSE[_KINDS[ord(",")]], _COARSE[_KINDS[ord(".")]] = 7, 7
N_COARSE = 8


def describe(text: bytes | None) -> np.ndarray:
    """The features of one text; those of a NULL or empty text are all 0."""
    text = text or b""
    out = np.zeros(N_FEATURES)
    if not text:
        return out
    kinds = _KINDS[np.frombuffer(text, np.uint8)]
    coarse = _COARSE[kinds]
    words, lines = text.split(), text.split(b"\n")
    n, n_words = len(kinds), max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    distinct = len(set(words))
    pairs = set(zip(words, words[1:], words[2:]))
    shares = np.bincount(kinds, minlength=N_KINDS) / n
    followed = np.bincount(coarse[:-1] * N_COARSE + coarse[1:], minlength=N_COARSE**2) / n
    filled = [line for line in lines if line.strip()]
    own = [
        np.log1p(n),
        np.log1p(len(words)),
        lengths.mean() if len(words) else 0.0,
        lengths.std() if len(words) else 0.0,
        distinct / n_words,
        1 - len(pairs) / max(1, len(words) - 2) if len(words) > 2 else 0.0,
        1 - len(set(filled)) / max(1, len(filled)),
        len(lines) / n_words,
        np.log1p(n / len(lines)),
        float((lengths > 15).mean()) if len(words) else 0.0,
        float((lengths < 3).mean()) if len(words) else 0.0,
        max(map(len, filled), default=0) / n,
    ]
    out[: len(own)] = own
    out[len(own) :] = np.sqrt(np.concatenate([shares, followed]))
    return out


N_FEATURES = 12 + N_KINDS + N_COARSE**2


@dataclass
class Ranking:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.centre) / self.scale, -6, 6) @ self.weights

    def scores(self, features: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the quantile that parts good from bad."""
        return sigmoid((self.raw(features) - self.threshold) / self.spread)


def preference_pairs(labels: np.ndarray, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of good and of bad documents, so paired that all occur about equally often."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    count = min(pairs, len(good) * len(bad))
    if not count:
        return good[:0], bad[:0]
    # step through both lists side by side, moving one list on by a place whenever both are back at a common start
    nth = np.arange(count)
    cycle = np.lcm(len(good), len(bad))
    return good[nth % len(good)], bad[(nth + nth // cycle) % len(bad)]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    pairs: int = PAIRS,
) -> Ranking:
    """A ranking learned from at most ``sample_rows`` labelled rows for which ``usable`` (over ``id``) holds."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [describe(text.as_py()) for text in batch.column("text")]
            arrays = [batch.column("id"), batch.column("label"), pa.array(rows, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "x"])

    rows = labelled(docs, labels, label, usable, sample_rows, id_col, text_col)
    found = rows.mapInArrow(described, "id long, label int, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, N_FEATURES)
    y, ids = found.column("label").to_numpy(), found.column("id").to_numpy()
    order = np.lexsort((*x.T[:3], ids))  # the same sums in every run
    return rank(x[order], y[order], pairs)


def rank(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS) -> Ranking:
    centre = x.mean(0) if len(x) else np.zeros(N_FEATURES)
    scale = x.std(0) + 1e-3 if len(x) else np.ones(N_FEATURES)
    good, bad = preference_pairs(y, pairs)
    if not len(good):  # nothing to prefer: every document has the middle score
        return Ranking(centre, scale, np.zeros(x.shape[1]), 0.0, 1.0)
    z = np.clip((x - centre) / scale, -6, 6)
    weights = fit_logistic(z[good] - z[bad], np.ones(len(good)), ridge=1e-3, intercept=False)
    raw = z @ weights
    share = (y == 0).mean()
    low, high = np.quantile(raw, [share, min(1.0, share + 1 / len(raw))])
    return Ranking(centre, scale, weights, float((low + high) / 2), 1.0)


def score_quality(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, 0 to 1. NULL and empty texts are scored as texts whose features are 0;
    repeated rows score alike; without labels of both kinds every row scores 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = np.stack([describe(text.as_py()) for text in batch.column("text")])
            arrays = [batch.column("id"), pa.array(shared.value.scores(features))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "score"])

    return with_text(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
