"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled texts:
one on ordinary text, one on the passages of toxic text that ordinary text does
not share (runs of byte 5-grams found in far more toxic documents than
ordinary ones).  Each window of a text is compressed twice, with the ordinary
dictionary alone and with the toxic one before it; the bytes saved are the
window's distance.  A document's score is a logistic function of its largest
window distance, of their sum, of the number of windows that pass a distance of
3 and of the number of windows, calibrated on labelled texts that the toxic
dictionary has not seen (the ordinary one is trained on all ordinary texts of
the sample).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.labelled import fold, training_sample

GRAM = 5  # bytes; also the least match that the compressor looks for
WINDOW = 12  # words
ORDINARY_BYTES, TOXIC_BYTES = 32768, 8192


def _windows(text: str | None) -> list[bytes]:
    words = (text or "").lower().encode("utf-8", "replace").split()
    return [b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)] or [b""]


def _grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    g = np.zeros(max(0, len(a) - GRAM + 1), np.uint64)
    for i in range(GRAM):
        g = (g << np.uint64(8)) | a[i:i + len(g)]
    return g


def _frequencies(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)


def _telling(toxic: list[bytes], ordinary: list[bytes], support: float = 0.015, ratio: float = 60.0) -> np.ndarray:
    """Grams of a share of ``support`` of the toxic documents (4 at least) that are ``ratio`` times as frequent in them."""
    grams, n = _frequencies(toxic)
    other, m = _frequencies(ordinary)
    at = np.minimum(np.searchsorted(other, grams), len(other) - 1)
    m = np.where(other[at] == grams, m[at], 0)
    return grams[(n >= max(4, support * len(toxic))) & (n / len(toxic) > ratio * m / len(ordinary))]


def _passages(text: bytes, telling: np.ndarray) -> list[bytes]:
    """Maximal runs of ``text`` that telling grams cover."""
    hit = np.flatnonzero(np.isin(_grams(text), telling))
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + GRAM, -1)
    cover = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
    ends = np.flatnonzero(np.diff(cover))
    return [text[a:b] for a, b in zip(ends[::2], ends[1::2])]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\0".join(dict.fromkeys(samples))[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(6, min_match=GRAM, write_content_size=False,
                                                            write_checksum=False, write_dict_id=False)
    trained = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=params)


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray  # of 1, largest distance, logs of summed distances, of distant windows and of windows

    def compressors(self):
        # The toxic part stands first, so that ordinary matches cost the same in both.
        return _compressor(self.ordinary), _compressor(self.toxic + b"\0" + self.ordinary)


def _features(text: str | None, plain, both) -> tuple[float, ...]:
    most = total = far = count = 0
    for w in _windows(text):
        saved = len(plain.compress(w)) - len(both.compress(w))
        most, total, far, count = max(most, saved), total + max(0, saved - 1), far + (saved >= 3), count + 1
    return 1.0, min(most, 12), math.log1p(total), math.log1p(far), math.log(count)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
    return w


def fit(sample: list[tuple[str, int]]) -> ToxicityModel:
    """Toxic dictionary from two of three sample texts, ordinary one from all of them, weights from the third."""
    sample = [(t, y) for t, y in {t: y for t, y in sample}.items()]
    flat = [(b" " + b" ".join(t.lower().encode("utf-8", "replace").split()) + b" ", y) for t, y in sample]
    learn = [x for i, x in enumerate(flat) if i % 3]
    toxic, ordinary = ([t for t, y in learn if y == k] for k in (1, 0))
    rate = (sum(y for _, y in sample) + 0.5) / (len(sample) + 1)
    if not toxic or not ordinary:  # nothing to tell apart: the base rate for all
        return ToxicityModel(b"", b"", np.array([np.log(rate / (1 - rate)), 0.0, 0.0, 0.0, 0.0]))
    telling = _telling(toxic, ordinary)
    marked = [b"\0".join(p) + b"\0" for p in (_passages(t, telling) for t in toxic) if p]
    model = ToxicityModel(_dictionary([w for t, y in sample if not y for w in _windows(t)], ORDINARY_BYTES),
                          _dictionary(marked, TOXIC_BYTES), np.zeros(5))
    pair = model.compressors()
    rest = [x for i, x in enumerate(sample) if i % 3 == 0]
    model.weights = _logistic(np.array([_features(t, *pair) for t, _ in rest]), np.array([y for _, y in rest], float))
    return model


def _score(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors()
        for batch in batches:
            x = np.array([_features(t.as_py(), *pair) for t in batch.column(1)]).reshape(-1, 5)
            score = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_fold: int = 0,
          per_class: int = 3000, max_chars: int = 20_000) -> ToxicityModel:
    """Fit on at most ``per_class`` rows of each label outside the held-out fold."""
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return fit(training_sample(docs, labels, label, held, per_class, max_chars))


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text, in windows of 12 words.

    Null, empty and blank texts are one empty window and get the score of a text
    without toxic matches.  Repeated rows are scored each; an empty table gives
    no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "id long, score double").withColumnRenamed("id", "doc_id")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns and rows else as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors()
        for batch in batches:
            x = np.array([_features(t.as_py(), *pair) for t in batch.column(names.index("text"))]).reshape(-1, 5)
            score = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
            yield batch.take(pa.array(np.flatnonzero(score < threshold)))

    return docs.mapInArrow(run, docs.schema)
