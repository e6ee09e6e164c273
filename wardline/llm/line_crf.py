"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its emission weights see its own surface features
and those of the lines before and after; transition weights tie neighbours
together.  Forward-backward marginals of "good", averaged with the lines'
lengths as weights, make the document's quality, which a logistic function of
that average log-odds calibrates against document labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.labelled import fold, training_sample

# Byte classes: capitals, small letters, digits, blanks, marks, punctuation, bytes of other characters.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c",
            b"!#$%&*|<>{}[]^~=_\\@+/", b".,;:?'\"()-", bytes(range(128, 256))]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _i
_SHARES = (0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7)  # steps of a share of bytes
_WORDS = (1, 2, 4, 8, 16, 32, 64, 128)  # steps of the number of words
_FRESH = (0.3, 0.5, 0.7, 0.8, 0.9, 0.97)  # steps of the share of distinct words
OWN = len(_CLASSES) * len(_SHARES) + len(_WORDS) + len(_FRESH) + 1
FEATURES = 3 * OWN + 3


def _lines(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [x for x in data.split(b"\n") if x.strip()] or [b""]


def line_features(docs: list[list[bytes]]) -> np.ndarray:
    """A row per line: steps reached by its shares of byte classes, words, distinct words and by repetition in
    the document, the same of the line before and after, and being first or last."""
    lines = [x for d in docs for x in d]
    sizes = np.array([len(x) for x in lines])
    share = np.zeros((len(lines), len(_CLASSES)))
    data = np.frombuffer(b"".join(lines), np.uint8)
    at = np.cumsum(sizes) - sizes
    some = sizes > 0
    if len(data):
        kind = _CLASS_OF[data]
        for c in range(len(_CLASSES)):
            share[some, c] = np.add.reduceat((kind == c).astype(np.int32), at[some])
    share /= np.maximum(1, sizes)[:, None]
    words, fresh, again = np.zeros(len(lines)), np.zeros(len(lines)), np.zeros(len(lines))
    i = 0
    for d in docs:
        seen: set[bytes] = set()
        for x in d:
            w = x.split()
            words[i], fresh[i], again[i] = len(w), len(set(w)) / max(1, len(w)), x in seen
            seen.add(x)
            i += 1
    own = np.concatenate([(share[:, :, None] >= np.array(_SHARES)).reshape(len(lines), -1), words[:, None] >= np.array(_WORDS),
                          fresh[:, None] >= np.array(_FRESH), again[:, None]], axis=1).astype(np.float32)
    ends = np.cumsum([len(d) for d in docs])
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    first[ends - [len(d) for d in docs]], last[ends - 1] = True, True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((len(lines), 1))], axis=1, dtype=np.float32)


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of chains laid end to end (emission log-odds of "good"), P(good) per line, the summed
    neighbour-pair marginals, and the log partition.  Chains advance together, longest first."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    e = np.stack([np.zeros(len(emit)), emit], axis=1)
    alpha, beta = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    alpha[starts] = e[starts]
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # chains of at least so many lines
    for t in range(1, longest):
        at = starts[:live[t]] + t
        alpha[at] = e[at] + np.logaddexp(alpha[at - 1, :1] + trans[0], alpha[at - 1, 1:] + trans[1])
    for t in range(longest - 2, -1, -1):
        at = starts[:live[t + 1]] + t
        onward = e[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(onward[:, :1] + trans[:, 0], onward[:, 1:] + trans[:, 1])
    z = np.logaddexp(*alpha[starts + sizes - 1].T)
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50)))
    inner = np.ones(len(emit), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    chain = np.empty(len(emit))
    for_z = np.repeat(z, sizes)
    chain[np.repeat(starts, sizes) + np.arange(len(emit)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = for_z
    pair = alpha[at - 1][:, :, None] + trans + (e + beta)[at][:, None, :] - chain[at][:, None, None]
    return good, np.exp(np.clip(pair, -50, 0)).sum(axis=0), float(z.sum())


@dataclass
class CrfModel:
    weights: np.ndarray
    trans: np.ndarray
    calibration: tuple[float, float]

    def quality(self, docs: list[list[bytes]]) -> np.ndarray:
        """Length-weighted mean marginal log-odds of each document."""
        lengths = np.array([len(d) for d in docs])
        good, _, _ = marginals(line_features(docs) @ self.weights, lengths, self.trans)
        good = np.clip(good, 1e-6, 1 - 1e-6)
        weight = np.array([1.0 + len(x) for d in docs for x in d])
        at = np.cumsum(lengths) - lengths
        mean = np.add.reduceat(weight * good, at) / np.add.reduceat(weight, at)
        return np.log(mean / (1 - mean))

    def scores(self, docs: list[list[bytes]]) -> np.ndarray:
        if not docs:
            return np.zeros(0)
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a + b * self.quality(docs), -30, 30)))


def fit(sample: list[tuple[str, int]], threshold: float = 0.7, steps: int = 120, ridge: float = 2.0) -> CrfModel:
    """Maximum conditional likelihood, each line labelled as its document is (Adam on two of three texts);
    the third calibrates: ``threshold`` falls midway between the labels."""
    sample = [(t, y) for t, y in {t: y for t, y in sample}.items()]
    learn = [(_lines(t), y) for i, (t, y) in enumerate(sample) if i % 3]
    rest = [(_lines(t), y) for i, (t, y) in enumerate(sample) if i % 3 == 0]
    model = CrfModel(np.zeros(FEATURES), np.zeros((2, 2)), (0.0, 1.0))
    rate = (sum(y for _, y in sample) + 0.5) / (len(sample) + 1)
    if len({y for _, y in learn}) < 2 or len({y for _, y in rest}) < 2:  # nothing to tell apart
        model.calibration = (float(np.log(rate / (1 - rate))), 0.0)
        return model
    docs = [d for d, _ in learn]
    x, lengths = line_features(docs), np.array([len(d) for d in docs])
    y = np.repeat([y for _, y in learn], lengths).astype(float)
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    real = np.zeros((2, 2))
    for n, (_, label) in zip(lengths, learn):
        real[label, label] += n - 1
    for step in range(1, steps + 1):
        good, pairs, _ = marginals(x @ theta[:FEATURES], lengths, theta[FEATURES:].reshape(2, 2))
        grad = np.concatenate([x.T @ (good - y), (pairs - real).ravel()]) + ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    model.weights, model.trans = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
    q, label = model.quality([d for d, _ in rest]), np.array([y for _, y in rest])
    # The cut lies midway between the bulk of the bad and the bulk of the good documents.
    cut = (np.quantile(q[label == 0], 0.98) + np.quantile(q[label == 1], 0.02)) / 2
    model.calibration = (float(np.log(threshold / (1 - threshold)) - cut), 1.0)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_fold: int = 2,
          per_class: int = 2500, max_chars: int = 20_000) -> CrfModel:
    """Fit on at most ``per_class`` rows of each label outside the held-out fold."""
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return fit(training_sample(docs, labels, label, held, per_class, max_chars))


def quality_scores(docs: DataFrame, model: CrfModel) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text.

    Null, empty and blank texts are one empty line.  Repeated rows are scored
    each; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, held, size = [], [], 0
            for t in batch.column(1):
                lines = _lines(t.as_py())
                held.append(lines)
                size += len(lines)
                if size >= 20_000:
                    scores.append(model.scores(held))
                    held, size = [], 0
            scores.append(model.scores(held))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], names=["id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double").withColumnRenamed("id", "doc_id")
