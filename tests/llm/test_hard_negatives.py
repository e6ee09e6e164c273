"""Hard negatives against a plain scan of all pairs."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from wardline.llm import hard_negatives as hn

COLS = "vec_id long, embedding array<float>, label {}"


def plain(rows, positives=5, negatives=10, low=30, high=90, every=10):
    """(anchor, positive, rank, negative, scores) of (id, vector, label) rows."""
    fit = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), l) for i, v, l in rows
           if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a, l in {r for r in fit if r[0] % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, m) for j, b, m in fit if j != i and len(a) == len(b))
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            p = -s
            inside = [x for x in scored if x[2] != l and low * p <= -100 * x[0] <= high * p][:negatives]
            out += [(i, j, k + 1, n, p, -t) for k, (t, n, _) in enumerate(inside)]
    return sorted(out)


def mined(df, every=10, **options):
    got = hn.hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def vectors(seed, n, dim, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    return [(i, [c * 0.7 + rng.gauss(0, 0.8) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


def test_equals_plain_scan_over_many_blocks(spark, monkeypatch):
    rows = vectors(1, 400, 12)
    rows += [(i + 1000, list(v), l) for i, v, l in rows[:60]]                       # ties: copies under other ids
    rows += [(5000 + i, v, 7) for i, v, l in vectors(2, 300, 12)]                    # a label of a third of all rows
    df = spark.createDataFrame(rows, COLS.format("int")).withColumn("dim", F.lit("x")).withColumn("key", F.lit(None)).withColumn("rank", F.lit(0))
    want = plain(rows)
    assert mined(df) == want and {r[2] for r in want} == set(range(1, 11))
    monkeypatch.setattr(hn, "NUMBERS", 12 * 50)  # 16 blocks, 4 stripes, 10 sets of anchors
    monkeypatch.setattr(hn, "ANCHORS", 8)
    assert mined(df) == want
    assert mined(df.withColumn("label", F.concat(F.lit("l"), "label"))) == want      # text labels
    assert mined(df, positives=2, negatives=3, low=50, high=100) == plain(rows, 2, 3, 50, 100)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [2.0, 1.0], 2), (1, [1.0, 2.5], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1),
            (5, [inf, 1.0], 2), (None, [1.0, 2.0], 2), (6, [1.0, 1.0], None), (7, [0.5, 0.5], 2), (7, [0.6, 0.5], 2), (8, [1.0, 2.0, 3.0], 2),
            (9, [], 1), (10, [], 1), (20, [], 2), (11, [0.0, 0.0], 3), (30, [-1.0, -1.0], 1), (12, [1e-30, -1e-30], 2), (13, [1.0, 1.0], 4)]
    df = spark.createDataFrame(rows, COLS.format("int"))
    assert mined(df) == plain(rows)
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 13")) == []
    wide = spark.createDataFrame([(0, [200.0] * 3, 1), (1, [300.0] * 3, 1), (2, [100.0, -200.0, 300.0], 2), (3, [1e30] * 3, 2)],
                                 "vec_id long, embedding array<double>, label long")
    assert mined(wide) == plain([(0, [200.0] * 3, 1), (1, [300.0] * 3, 1), (2, [100.0, -200.0, 300.0], 2)])


def test_bounds_drop_candidates_before_all_columns_are_read():
    rng = np.random.default_rng(0)
    x = (rng.normal(0, 60, (3000, 64))).astype(np.int64)
    table = hn._pack(hn.pa.table({"dim": hn.pa.array([64] * 3000, hn.pa.int32()), "slot": hn.pa.array([0] * 3000, hn.pa.int32()), "id": list(range(3000)),
                                  "key": [0] * 3000, "vector": hn.pa.array(list(x), hn.pa.list_(hn.pa.int64()))}))
    block, sizes, q = hn._Block(table.to_pylist()[0]), [], x[0]

    def prune(low, high):
        sizes.append(len(low))
        assert ((low <= high).all())
        return high >= hn._kth(low, 5)

    alive, score = block.scan(q, np.arange(3000), prune)
    assert sorted(score, reverse=True)[:5] == sorted(x @ q, reverse=True)[:5] and sizes[-1] < 300 < sizes[0]
    assert (score == (x @ q)[alive]).all()
