"""Hard negatives by a vertical scan of the dimensions (branch and bound on decomposed data).

Vectors are whole numbers, stored in blocks as columns, one for each dimension,
with the least and the greatest value of every column.  For an anchor a block's
columns are read in the order of the anchor's descending magnitude.  What the
columns not read yet can still add, at least and at most, bounds every
candidate's score; candidates whose bounds leave all windows that are still open
fall out of the bitmap, and the few that are left are summed up exactly.  The
first scan finds an anchor's positives, the second one the negatives in the
score windows that these open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import materialise

NUMBERS = 1 << 20  # numbers of a block
ANCHORS = 128  # anchors that meet a block together
STRIPE = 4  # blocks that a task scans one after the other, with one list of the best so far
MOST = 1 << 23  # whole numbers of a larger magnitude are out of range

_BLOCK = "dim int, slot int, ids binary, keys binary, columns binary, width int, least array<long>, most array<long>"
_BLOCK_ARROW = pa.schema([("dim", pa.int32()), ("slot", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()), ("columns", pa.binary()),
                          ("width", pa.int32()), ("least", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))])


def _whole(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(vectors.combine_chunks().flatten(), dtype=np.int64).reshape(len(vectors), dim)


def _pack(table: pa.Table) -> pa.Table:
    """One block: rows sorted by label key, vectors as columns of the least width that holds them."""
    dim, slot = table["dim"][0].as_py(), table["slot"][0].as_py()
    ids, keys = np.asarray(table["id"]), np.asarray(table["key"])
    order = np.lexsort((ids, keys))
    x = _whole(table["vector"], dim)[order].T
    least, most = x.min(axis=1), x.max(axis=1)
    width = 2 if not dim or max(-least.min(), most.max()) < 1 << 15 else 4
    row = (dim, slot, ids[order].tobytes(), keys[order].tobytes(), np.ascontiguousarray(x, f"i{width}").tobytes(), width, least, most)
    return pa.Table.from_arrays([pa.array([v], t.type) for v, t in zip(row, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


class _Block:
    def __init__(self, row: dict):
        self.ids, self.keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
        self.columns = np.frombuffer(row["columns"], f"i{row['width']}").reshape(row["dim"], len(self.ids))
        self.least, self.most = (np.array(row[k], np.int64) for k in ("least", "most"))

    def scan(self, q: np.ndarray, alive: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``alive`` that ``prune(low, high)`` leaves, with their exact products with ``q``.

        ``low`` and ``high`` bound the products given the columns read so far.
        """
        order = np.argsort(-np.abs(q), kind="stable")
        ends = q[:, None] * np.stack([self.least, self.most], axis=1)
        lowest, highest = ends.min(axis=1)[order], ends.max(axis=1)[order]
        rest_low, rest_high = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (lowest, highest))
        score = np.zeros(len(alive), np.int64)
        step = max(4, len(q) // 8)
        for at in range(0, len(q), step):
            for d in order[at:at + step]:
                score += q[d] * self.columns[d].take(alive).astype(np.int64)
            done = min(at + step, len(q))
            keep = prune(score + rest_low[done], score + rest_high[done])
            if keep is not None:
                alive, score = alive[keep], score[keep]
                if not len(alive):
                    break
        return alive, score


def _kth(values: np.ndarray, k: int) -> int:
    """The k-th greatest value."""
    return int(np.partition(values, len(values) - k)[len(values) - k])


class _Best:
    """The first ``k`` of the rows seen, by descending score, then id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def floor(self) -> int | None:
        """Rows below this score cannot come in any more."""
        return int(self.scores[-1]) if len(self.scores) >= self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            least = _kth(scores, self.k)
            scores, ids = scores[scores >= least], ids[scores >= least]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def _anchor_rows(anchors: pa.Table) -> Iterator[tuple[dict, np.ndarray]]:
    for r in anchors.to_pylist():
        yield r, np.array(r["vector"], np.int64)


_POSITIVE = "rid long, anchor_id long, positive_id long, positive_score long"


def _positives(k: int):
    """Of a stripe of blocks: the first ``k`` rows of each anchor's label."""

    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        blocks, out = [_Block(r) for r in blocks.to_pylist()], []
        for r, q in _anchor_rows(anchors):
            best = _Best(k)
            for b in blocks:
                first, last = np.searchsorted(b.keys, r["key"], "left"), np.searchsorted(b.keys, r["key"], "right")
                alive = np.arange(first, last)
                alive = alive[b.ids[alive] != r["id"]]

                def prune(low, high):
                    floor = best.floor()
                    if len(low) > k:
                        floor = max(_kth(low, k), floor if floor is not None else low.min())
                    return None if floor is None else high >= floor

                if len(alive):
                    alive, score = b.scan(q, alive, prune)
                    best.add(score, b.ids[alive])
            out += [(r["rid"], r["id"], i, s) for s, i in zip(best.scores.tolist(), best.ids.tolist())]
        return _table(out, ("rid", "anchor_id", "positive_id", "positive_score"))

    return run


_NEGATIVE = "rid long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"


def _negatives(k: int, low_share: int, high_share: int):
    """Of a stripe of blocks: the first ``k`` rows of other labels in each window that a positive opens."""

    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        blocks, out = [_Block(r) for r in blocks.to_pylist()], []
        for r, q in _anchor_rows(anchors):
            windows = {}
            for p in {x["positive_score"] for x in r["positives"]}:
                least, most = -((-low_share * p) // 100), (high_share * p) // 100
                if least <= most:
                    windows[p] = (least, most, _Best(k))

            def prune(low, high):
                keep = np.zeros(len(low), bool)
                for least, most, best in windows.values():
                    floor = best.floor()
                    floor = least if floor is None else max(least, floor)
                    sure = low[(low >= least) & (high <= most)]  # these are inside the window whatever is to come
                    if len(sure) >= k:
                        floor = max(floor, _kth(sure, k))
                    keep |= (high >= floor) & (low <= most)
                return keep

            for b in blocks if windows else ():
                first, last = np.searchsorted(b.keys, r["key"], "left"), np.searchsorted(b.keys, r["key"], "right")
                alive = np.concatenate([np.arange(first), np.arange(last, len(b.keys))])
                alive = alive[b.ids[alive] != r["id"]]
                if len(alive):
                    alive, score = b.scan(q, alive, prune)
                    for least, most, best in windows.values():
                        inside = (score >= least) & (score <= most)
                        best.add(score[inside], b.ids[alive[inside]])
            for x in r["positives"]:
                if x["positive_score"] in windows:
                    best = windows[x["positive_score"]][2]
                    out += [(r["rid"], r["id"], x["place"], x["positive_id"], x["positive_score"], i, s)
                            for s, i in zip(best.scores.tolist(), best.ids.tolist())]
        return _table(out, ("rid", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"))

    return run


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as floor(scale * x); the score of two vectors is their
    inner product, exact in whole numbers.  Higher scores come first, ties by
    smaller id.  The positives of an anchor are the first ``positives`` other
    rows of its label; for each of them, the rows of other labels whose score is
    ``low`` to ``high`` percent of the positive's are its candidates, and the
    first ``negatives`` come back with their rank.

    Rows with a null id, label or vector, or with a component that is null, not
    finite or beyond ``MOST`` after scaling, take no part.  Only vectors of
    equal length meet.  Rows that repeat an id are rows of their own, but no row
    of an anchor's id is its positive or negative; an anchor that is repeated as
    a whole counts once.  An anchor without positives, or with negative scores
    only, gives no rows, as does an empty table.  Labels that are no whole
    numbers are compared by a 64-bit hash.

    Anchors meet all rows by blocks: each pair of ``ANCHORS`` anchors and
    ``STRIPE`` blocks of ``NUMBERS`` numbers is a group of one task, whatever
    the labels are; nothing is broadcast.
    """
    row = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("x"),
                         F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    whole = isinstance(row.schema["label"].dataType, T.IntegralType)
    key = F.col("label").cast("long") if whole else F.xxhash64("label")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > (MOST - 1) / scale))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(odd, F.lit(True))
    row = row.where(fit).select("id", key.alias("key"), F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("vector"),
                                F.size("x").alias("dim"), "anchor")
    # Rows are dealt to blocks by their place in the input, so that no id or vector can crowd a block.
    row = materialise(row.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "bond-rows")
    slots = row.groupBy("dim").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * F.col("dim") / NUMBERS)).cast("int").alias("slots"),
                                   F.greatest(F.lit(1), F.ceil(F.count_if("anchor") / ANCHORS)).cast("int").alias("sets"))
    slots = materialise(slots.withColumn("stripes", F.ceil(F.col("slots") / STRIPE).cast("int")), "bond-slots")
    dealt = row.join(slots, "dim").withColumn("slot", F.pmod("deal", F.col("slots")).cast("int"))
    blocks = materialise(dealt.select("dim", "slot", "id", "key", "vector").groupBy("dim", "slot").applyInArrow(_pack, _BLOCK), "bond-blocks")
    rid = F.xxhash64("id", "key", "vector")
    anchors = row.where("anchor").select("id", "key", "vector", "dim").distinct().withColumn("rid", rid).join(slots, "dim")
    anchors = materialise(anchors.withColumn("set", F.pmod(F.xxhash64("rid"), F.col("sets")).cast("int")), "bond-anchors")

    blocks = blocks.join(slots.select("dim", "sets", "stripes"), "dim").withColumn("stripe", F.pmod("slot", F.col("stripes")))
    blocks = blocks.withColumn("set", F.explode(F.sequence(F.lit(0), F.col("sets") - 1))).drop("sets", "stripes")
    at = ["dim", "set", "stripe"]

    def scan(side: DataFrame, fn, schema: str) -> DataFrame:
        side = side.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1))).drop("stripes", "slots", "sets")
        return blocks.groupBy(*at).cogroup(side.groupBy(*at)).applyInArrow(fn, schema)

    found = materialise(scan(anchors, _positives(positives), _POSITIVE), "bond-positives")
    first = W.partitionBy("rid").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(first).cast("long")).where(F.col("place") <= positives)
    opened = found.groupBy("rid").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))
    near = materialise(scan(anchors.join(opened, "rid"), _negatives(negatives, low, high), _NEGATIVE), "bond-negatives")
    order = W.partitionBy("rid", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
