"""Toxicity by non-negative positive-unlabelled learning.

Numpy logistic classifiers over hashed words and word beginnings, fitted to confirmed toxic
rows and unlabelled rows. The risk on unlabelled text is corrected by the class prior; where
the corrected part turns negative, the step goes back instead (the non-negative estimator).
Several classifiers on resampled rows are averaged.

Training sees a bounded, hash-chosen sample; scoring sees every word of every text.

Defined cases: a null or empty text scores as a text without known words; without a single
toxic or unlabelled row every score is 0; a row labelled twice is toxic if either says so;
repeated rows get equal rows; words of any length count whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, text_slices
from .words import LetterWords

FEATURE_BITS = 21
PREFIXES = (4, 5, 6, 7)
#: The bounded sample that training sees, and the features it keeps.
MAX_TOXIC, MAX_UNLABELLED, MAX_FEATURES = 2500, 5000, 1500
THRESHOLD = 0.7


@dataclass
class PuModel:
    features: np.ndarray  # hashes, ascending
    weights: np.ndarray
    bias: float


def _hashed(words: LetterWords) -> np.ndarray:
    """Hashed features of each distinct word, one row for each."""
    columns = [words.whole(), *(words.prefixes(n) for n in PREFIXES)]
    return (np.stack(columns, axis=1) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _present(words: LetterWords, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, distinct word) for every word that a row has, once."""
    owner = np.repeat(np.arange(rows), np.diff(words.first))
    pairs = np.unique(owner * max(1, len(words)) + words.at)
    return pairs // max(1, len(words)), pairs % max(1, len(words))


def sample_features(rows: DataFrame) -> list[np.ndarray]:
    """The distinct hashed features of each text of a bounded table."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = LetterWords(part.column(0))
                hashed = _hashed(words)
                row, word = _present(words, part.num_rows)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                lists = [np.unique(hashed[word[a:b]]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in lists], pa.binary())], ["f"])

    return [np.frombuffer(r[0], np.int64) for r in rows.select("text").mapInArrow(released(run), "f binary").collect()]


def _softplus_slope(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, members: int = 3, steps: int = 250, rate: float = 0.05, decay: float = 2e-4, seed: int = 5) -> PuModel | None:
    """Classifiers that minimise the non-negative PU risk, averaged in their logits."""
    if not toxic or not unlabelled:
        return None
    size, rng = 1 << FEATURE_BITS, np.random.default_rng(seed)
    in_toxic, in_all = (np.bincount(np.concatenate(x), minlength=size) for x in (toxic, unlabelled))
    p, q = in_toxic / len(toxic), (in_all + 0.5) / (len(unlabelled) + 1)
    surprise = (p - q) / np.sqrt(q * (1 - np.minimum(q, 0.999)) / len(toxic) + q / len(unlabelled))
    good = np.flatnonzero((in_toxic >= max(3, len(toxic) // 200)) & (surprise > 5))
    good = np.sort(good[np.argsort(-surprise[good], kind="stable")[:MAX_FEATURES]])
    prior = float(np.clip(prior, 1e-3, 0.5))

    def matrix(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), len(good)), np.float32)
        for i, row in enumerate(rows):
            at = np.searchsorted(good, row)
            at = at[(at < len(good)) & (good[np.minimum(at, len(good) - 1)] == row)] if len(good) else at[:0]
            out[i, at] = 1
        return out

    xp, xu = matrix(toxic), matrix(unlabelled)
    weights, biases = [], []
    for _ in range(members):
        bp, bu = xp[rng.integers(len(xp), size=len(xp))], xu[rng.integers(len(xu), size=len(xu))]
        w, b = np.zeros(len(good)), float(np.log(prior / (1 - prior)))
        m, v = np.zeros(len(good) + 1), np.zeros(len(good) + 1)
        for t in range(1, steps + 1):
            gp, gu = bp @ w.astype(np.float32) + b, bu @ w.astype(np.float32) + b
            corrected = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            slope_u, slope_p = _softplus_slope(gu) / len(gu), prior * _softplus_slope(gp) / len(gp)
            negative = np.append(bu.T @ slope_u - bp.T @ slope_p, slope_u.sum() - slope_p.sum())
            if corrected >= 0:
                slope = -prior * _softplus_slope(-gp) / len(gp)
                grad = negative + np.append(bp.T @ slope, slope.sum())
                grad[:-1] += decay * w
            else:
                grad = -negative
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
        weights.append(w)
        biases.append(b)
    return PuModel(good, np.mean(weights, axis=0), float(np.mean(biases)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> PuModel | None:
    """Fit to the rows given: toxic ones among ``labels``, any of ``docs`` as unlabelled."""
    lot = F.xxhash64(F.col(id_col).cast("string"), F.lit(3))
    prior = labels.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0
    ids = labels.filter(F.col(label_col) == 1).select(id_col).distinct().orderBy(lot).limit(MAX_TOXIC)
    toxic = docs.join(F.broadcast(ids), id_col, "left_semi").orderBy(lot, F.xxhash64(text_col)).limit(2 * MAX_TOXIC).select(F.col(text_col).alias("text"))
    total = docs.count()
    share = int(min(1.0, MAX_UNLABELLED / max(1, total)) * (1 << 30))
    unlabelled = docs.filter(F.pmod(lot, F.lit(1 << 30)) < share).select(F.col(text_col).alias("text"))
    return fit(sample_features(toxic), sample_features(unlabelled), prior)


def score(docs: DataFrame, model: PuModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) per row."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                out = np.zeros(part.num_rows)
                if model is not None:
                    out += model.bias
                    words = LetterWords(part.column(1))
                    if len(words) and len(model.features):
                        hashed = _hashed(words)
                        at = np.minimum(np.searchsorted(model.features, hashed), len(model.features) - 1)
                        known = model.features[at] == hashed
                        row, word = _present(words, part.num_rows)
                        some = known.any(axis=1)[word]
                        row, word = row[some], word[some]
                        pick = known[word]
                        pairs = np.unique(np.repeat(row, pick.sum(axis=1)) * len(model.features) + at[word][pick])
                        out += np.bincount(pairs // len(model.features), model.weights[pairs % len(model.features)], part.num_rows)
                    out = _softplus_slope(out)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out), pa.array((out >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(released(run), "doc_id long, score double, predicted int")
