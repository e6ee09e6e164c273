"""Sampled subword segmentation over the piece lattice of a SentencePiece model.

Every segmentation of a text into pieces of the vocabulary is a path of a
lattice.  Forward filtering sums the probabilities of all paths to each
position; backward sampling then draws a path from the end, each piece with its
exact conditional probability.  Draws come from a counter-based generator keyed
by the row key, the word's place in the text and the step, so a row gets the
same pieces in any batch, partition or rerun.

No piece reaches from a word into the blanks of the next, so the lattice falls
apart at words; each distinct word of a batch is filtered once.  Characters
without a piece fall back to byte pieces, so decoding is lossless for any text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_BLANK = "▁"
_FOREIGN_BLANK = 0x110000  # stands for the blank sign where the text itself holds it: no piece matches it
_BASE, _U = np.uint64(0x100000001B3), np.uint64
_UNITS = re.compile(f"{_BLANK}+[^{_BLANK}\n]*|[^{_BLANK}\n]+|\n")
BATCH_CHARS = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalising step of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _mix(h * _BASE + code + _U(1))


class Vocabulary:
    """Pieces of a model with the log probabilities of their ranks (Zipf's law with exponent ``sharpness``)."""

    def __init__(self, model: str, sharpness: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        pieces = {i: sp.id_to_piece(i) for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if (self.byte_id == sp.unk_id()).any():
            raise ValueError("the model has no byte pieces: decoding would not be lossless")
        rank = {i: r for r, i in enumerate(sorted(pieces, key=lambda i: (-sp.get_score(i), i)))}
        total = np.log(((np.arange(n) + 10.0) ** -sharpness).sum())
        self.byte_score = float(-sharpness * np.log(n + 10.0) - total)
        ids = np.array(sorted(pieces), np.int32)
        sizes = np.array([len(pieces[i]) for i in ids.tolist()])
        codes = np.zeros((len(ids), sizes.max()), np.uint64)
        for r, i in enumerate(ids.tolist()):
            codes[r, :sizes[r]] = [ord(c) for c in pieces[i]]
        h, hashes, whole = np.zeros(len(ids), np.uint64), [], []
        for k in range(codes.shape[1]):
            on = np.flatnonzero(sizes > k)
            h[on] = _step(h[on], codes[on, k])
            hashes.append(h[on].copy())
            whole.append(np.where(sizes[on] == k + 1, ids[on], -1))
        # Every prefix of a piece, with the piece's id or -1.
        hashes, whole = np.concatenate(hashes), np.concatenate(whole)
        order = np.lexsort((-whole, hashes))
        hashes, first = np.unique(hashes[order], return_index=True)
        self.prefixes = pd.Index(hashes)
        self.piece = whole[order][first].astype(np.int32)
        self.score = np.array([-sharpness * np.log(rank[i] + 10.0) - total if i >= 0 else -np.inf for i in self.piece.tolist()])
        text = [b""] * n
        for i, p in pieces.items():
            text[i] = p.replace(_BLANK, " ").encode()
        for b, i in enumerate(self.byte_id.tolist()):
            text[i] = bytes([b])
        self.lengths = np.array([len(t) for t in text], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(text), np.uint8)


@lru_cache(maxsize=2)
def vocabulary(model: str, sharpness: float) -> Vocabulary:
    return Vocabulary(model, sharpness)


class _Lattice:
    """Edges of the lattices of distinct words, laid end to end, in the order of their end positions."""

    def __init__(self, vocab: Vocabulary, words: list[str]):
        sizes = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if (code == _FOREIGN_SIGN).any():
            code = np.where(code == _FOREIGN_SIGN, _U(_FOREIGN_BLANK), code)
        n = len(code)
        word = np.repeat(np.arange(len(words)), sizes)
        stop = np.cumsum(sizes)[word]  # of the word of each character
        # Nodes: a position before each character, and one at the end of each word.
        node = np.arange(n) + word
        self.first = np.cumsum(sizes) - sizes + np.arange(len(words))
        self.last = self.first + sizes
        at, h = np.arange(n), np.zeros(n, np.uint64)
        starts, ends, ids, scores = [], [], [], []
        single = np.zeros(n, bool)
        length = 0
        while len(at):
            h = _step(h, code[at + length])
            length += 1
            place = vocab.prefixes.get_indexer(h)
            known = place >= 0
            at, h, place = at[known], h[known], place[known]
            hit = vocab.piece[place] >= 0
            starts.append(node[at[hit]])
            ends.append(node[at[hit]] + length)
            ids.append(vocab.piece[place[hit]])
            scores.append(vocab.score[place[hit]])
            if length == 1:
                single[at[hit]] = True
            on = at + length < stop[at]
            at, h = at[on], h[on]
        lone = np.flatnonzero(~single)  # characters without a piece: one edge of their bytes
        raw = np.where(code[lone] == _FOREIGN_BLANK, _U(ord(_BLANK)), code[lone])
        width = 1 + (raw >= 0x80).astype(int) + (raw >= 0x800) + (raw >= 0x10000)
        starts.append(node[lone])
        ends.append(node[lone] + 1)
        ids.append((-1 - raw.astype(np.int64)).astype(np.int32))  # -1 - code point
        scores.append(width * vocab.byte_score)
        start, end, id_, score = (np.concatenate(x) for x in (starts, ends, ids, scores))
        depth = end - self.first[np.repeat(np.arange(len(words)), sizes + 1)[end]]
        order = np.argsort(end * (length + 1) + start - end)  # by end and start: no edge is longer than ``length``
        self.start, self.id, score, end, depth = start[order], id_[order], score[order], end[order], depth[order]
        # Forward filtering, all words a position at a time.
        alpha = np.zeros(n + len(words))
        by = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth, kind="stable")  # short keys sort faster
        cuts = np.searchsorted(depth[by], np.arange(1, (depth.max() if len(depth) else 0) + 2))
        for a, b in zip(cuts, cuts[1:]):
            e = by[a:b]
            heads = np.flatnonzero(np.diff(end[e], prepend=-1))
            alpha[end[e[heads]]] = np.logaddexp.reduceat(alpha[self.start[e]] + score[e], heads)
        # Per edge into a node, the upper bound of its share of 2**32 draws; the same sums for a word in any batch.
        share = np.exp(alpha[self.start] + score - alpha[end])
        heads = np.flatnonzero(np.diff(end, prepend=-1))
        nth = np.arange(len(end)) - np.repeat(heads, np.diff(np.append(heads, len(end))))
        upto = share.copy()
        for k in range(1, int(nth.max()) + 1 if len(nth) else 0):
            e = np.flatnonzero(nth == k)
            upto[e] += upto[e - 1]
        bound = np.minimum(upto * 2.0 ** 32, 2.0 ** 32).astype(np.uint64)
        bound[np.append(heads[1:], len(end)) - 1] = _U(1 << 32)
        self.draw = (end.astype(np.uint64) << _U(32)) + np.maximum(bound, _U(1)) - _U(1)

    def sample(self, words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each occurrence in order, and how many it has."""
        node, live = self.last[words].copy(), np.arange(len(words))
        who, what, count, step = [], [], np.zeros(len(words), np.int64), 0
        first = self.first[words]
        while len(live):
            u = _mix(keys[live] + _U(step * 0x9E3779B97F4A7C15 % (1 << 64))) >> _U(32)
            edge = np.searchsorted(self.draw, (node[live].astype(np.uint64) << _U(32)) + u)
            node[live] = self.start[edge]
            who.append(live)
            what.append(self.id[edge])
            count[live] += 1
            live, step = live[node[live] > first[live]], step + 1
        out = np.empty(count.sum(), np.int32)
        ends = np.cumsum(count)
        for s, (w, x) in enumerate(zip(who, what)):
            out[ends[w] - 1 - s] = x
        return out, count


# A character of private use and the blank sign, where a text holds them, are words of their own under these names,
# which no other word has (blanks only begin words).
_FOREIGN_SIGN = 0xE000F
_SIGN, _PRIVATE = f"s{_BLANK}", f"p{_BLANK}"
_CUTS = re.compile(f"([{_BLANK}{chr(_FOREIGN_SIGN)}])")


def encode(texts: list[str], keys: list[int], vocab: Vocabulary) -> list[np.ndarray]:
    """Sampled piece ids of each text."""
    if not texts:
        return []
    units: list[str] = []
    per_text = []
    for text in texts:
        before = len(units)
        # Texts that hold the blank sign or the private character are cut there; those characters become words of their own.
        for i, part in enumerate(_CUTS.split(text) if _CUTS.search(text) else [text]):
            if i % 2:
                units.append(_SIGN if part == _BLANK else _PRIVATE)
            else:
                units += _UNITS.findall((_BLANK if i == 0 else "") + part.replace(" ", _BLANK))
        per_text.append(len(units) - before)
    words = {w: i for i, w in enumerate(dict.fromkeys(units))}
    at = np.fromiter(map(words.__getitem__, units), np.int64, len(units))
    nth = np.arange(len(at)) - np.repeat(np.cumsum(per_text, dtype=np.int64) - per_text, per_text)
    keyed = _mix(np.repeat(np.array(keys, np.uint64), per_text) + nth.astype(np.uint64) * _U(0xD1342543DE82EF95))
    lattice = _Lattice(vocab, [chr(_FOREIGN_SIGN) if w in (_SIGN, _PRIVATE) else w for w in words])
    ids, count = lattice.sample(at, keyed)
    owner = np.repeat(np.arange(len(at)), count)
    if (ids < 0).any():  # byte fall-back: as many ids as the character has bytes
        private = words.get(_PRIVATE)
        out: list[list[int]] = []
        for i in np.flatnonzero(ids < 0):
            code = -1 - int(ids[i])
            if at[owner[i]] == private:
                code = _FOREIGN_SIGN
            out.append(vocab.byte_id[list(chr(code).encode("utf-8", "surrogatepass"))].tolist())
        width = np.ones(len(ids), np.int64)
        width[ids < 0] = [len(b) for b in out]
        low = np.repeat(ids, width)
        low[np.repeat(ids < 0, width)] = np.concatenate(out)
        ids, owner = low, np.repeat(owner, width)
    text_of = np.repeat(np.arange(len(texts)), per_text)
    sizes = np.bincount(text_of[owner], minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    return np.split(ids, np.cumsum(sizes)[:-1])


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of piece ids, without the blank that stands in front of every text."""
    sizes = vocab.lengths[ids]
    at = np.repeat(vocab.begins[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    return vocab.bytes[at].tobytes().decode("utf-8", "surrogatepass")[1:]


def _key(value, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(repr(value).encode(), seed)


def sample_pieces(docs: DataFrame, model: str = DEFAULT_MODEL, seed: int = 7, sharpness: float = 1.0, check: bool = False,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n_ids`` of every row of ``docs``; with ``check`` also ``lossless``, whether decoding gives the text.

    A null text has null ids (n_ids 0, lossless); an empty one is the single
    blank in front.  Rows that repeat an id and text get the same pieces.
    Whole texts are encoded; a task holds the lattices of about
    ``BATCH_CHARS`` characters, or of one text if that is longer.  An empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, sharpness)
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                rows.append((key.as_py(), text.as_py()))
                size += len(rows[-1][1] or "")
                if size >= BATCH_CHARS:
                    yield pieces(rows, vocab)
                    rows, size = [], 0
            if rows:
                yield pieces(rows, vocab)

    def pieces(rows: list[tuple], vocab: Vocabulary) -> pa.RecordBatch:
        some = [(k, t) for k, t in rows if t is not None]
        found = iter(encode([t for _, t in some], [_key(k, seed) for k, _ in some], vocab))
        ids = [None if t is None else next(found) for _, t in rows]
        cols = {"doc_id": pa.array([k for k, _ in rows], pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())),
                "n_ids": pa.array([0 if x is None else len(x) for x in ids], pa.int64())}
        if check:
            cols["lossless"] = pa.array([x is None or decode(x, vocab) == t for x, (_, t) in zip(ids, rows)])
        return pa.RecordBatch.from_pydict(cols)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_ids long" + (", lossless boolean" if check else ""))


def decode_pieces(pieces: DataFrame, model: str = DEFAULT_MODEL, sharpness: float = 1.0) -> DataFrame:
    """``doc_id, text`` of ``pieces(doc_id, ids)``; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model, sharpness)
        for batch in batches:
            texts = [decode(np.asarray(x.values), vocab) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pieces.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
