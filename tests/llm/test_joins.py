"""N-gram and vector joins against brute force, with groups, ties, nulls and repeated rows."""
import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import common, grid_join, ngram_join
from wardline.llm.common import components


@pytest.mark.parametrize("plain", [0, 20_000])
def test_components(spark, monkeypatch, plain):
    monkeypatch.setattr(common, "PLAIN_EDGES", plain)
    links = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 7), (2, 1), (20, 30), (30, 10)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.closure({x for p in links for x in p}, links)
    assert got == {k: v for k, v in want.items() if k != 3 or True}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(rng, n_base, copies):
    words = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    passage = [rng.choice(words) for _ in range(40)]
    for _ in range(n_base):
        base = [rng.choice(words) for _ in range(rng.randint(3, 80))] + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.choice(copies)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((i, " ".join(text)))
            i += 1
    return rows


def test_ngram_groups(spark, workdir, monkeypatch):
    rng = random.Random(5)
    rows = near_texts(rng, 40, [1, 2, 40])
    n = len(rows)
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \n"), (n + 4, "one two"), (n + 5, "One\x0bTWO"), (n + 6, "a b c d e f g"), (n + 7, "a b c d e f g h"),
             (n + 8, "É é x y z q"), (n + 9, "é é x y z q"), (n + 10, "q " * 30_000), (n + 11, "q " * 5)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, n int, rep int")
    docs.write.parquet(f"{workdir}/docs")
    docs = spark.read.parquet(f"{workdir}/docs")
    want = brute.ngram_groups(rows)
    assert len({v[1] for v in want.values()}) < 0.8 * len(want)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.ngram_groups(docs, rare=4, few_sets=3).collect()}   # all ways of the last round
    assert got == want
    got = ngram_join.ngram_groups(docs.unionByName(docs.limit(3)).withColumn("doc_id", F.when(F.col("doc_id") != 4, F.col("doc_id"))))
    assert got.count() == len(rows) + 3 and [r["component_id"] for r in got.where("doc_id is null").collect()] == [None]
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}
    assert ngram_join.ngram_groups(docs.where("doc_id < 0")).count() == 0


def test_rows_are_decided_by_their_texts(spark, workdir):
    """Repeated ids, null ids and repeated rows: one row of each group stays, and no text without a partner goes."""
    rng = random.Random(9)
    text = lambda n=60: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    a, c, d, e, f, g = (text() for _ in range(6))
    rows = [(1, a), (2, a + " more"), (2, c), (2, d), (4, d), (None, e), (None, e + " end"), (None, f), (7, f), (8, g), (8, g), (8, g + " x"),
            (9, None), (9, ""), (9, " "), (None, None), (10, "one"), (11, "one"), (12, "two"), (12, "two")]
    frame = spark.createDataFrame([(*r, i, i, i) for i, r in enumerate(rows)], "doc_id long, text string, _x_n long, n int, id long")
    frame.repartition(5).write.parquet(f"{workdir}/docs")
    docs = spark.read.parquet(f"{workdir}/docs")
    got = ngram_join.drop_near_copies(docs)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    null_e = [t for i, t in kept if i is None and t and t.startswith(e)]
    eight = [t for i, t in kept if i == 8]
    assert len(null_e) == 1 and len(eight) == 1
    assert kept == sorted([(1, a), (2, c), (2, d), (None, null_e[0]), (7, f), (8, eight[0]), (9, None), (9, ""), (9, " "), (None, None), (10, "one"), (12, "two")], key=str)
    groups = sorted(map(tuple, ngram_join.ngram_groups(docs).select("doc_id", "component_id").collect()), key=str)
    assert groups == sorted([(1, 1), (2, 1), (2, 2), (2, 2), (4, 2), *[(None, None)] * 4, (7, 7), *[(8, 8)] * 3, *[(9, 9)] * 3, (10, 10), (11, 10), (12, 12), (12, 12)], key=str)


def test_lists_of_documents_are_spread_over_parts(spark):
    docs = spark.range(60).selectExpr("id", "concat('text ', id) as text").repartition(30)
    lists = docs.mapInArrow(ngram_join._spread(5, 8), ngram_join._MAP).where("ids is not null").select("p").collect()
    assert len(lists) >= 25 and len({r["p"] for r in lists}) > 15


def test_similarities_that_need_keys_of_small_sets_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string")  # 2 and 3 n-grams, 2 shared
    for similarity in (2 / 3, 0.5):
        with pytest.raises(ValueError, match="above 2/3"):
            ngram_join.ngram_groups(docs, similarity)
        with pytest.raises(ValueError, match="above 2/3"):
            ngram_join.drop_near_copies(docs, similarity)


def test_index_keys_of_similar_sets_meet():
    """Any two sets of Jaccard 0.75 or more share a key, whatever the frequencies and sizes."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        universe = rng.permutation(np.arange(1, 3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        df = rng.integers(2, 200, len(universe)).astype(np.uint32)
        n = int(rng.integers(3, 300))
        gap = n // 7
        only_a, only_b = int(rng.integers(0, gap + 1)), int(rng.integers(0, gap + 1))
        shared = n - gap
        if shared < 0.75 * (shared + only_a + only_b):
            continue
        a, b = np.arange(shared + only_a), np.concatenate([np.arange(shared), shared + only_a + np.arange(only_b)])
        keys = [set(ngram_join.index_keys(np.sort(universe[x]), df[x][np.argsort(universe[x])], len(x), 0.75, 64).tolist()) for x in (a, b)]
        assert only_a + only_b == 0 or keys[0] & keys[1], (shared, only_a, only_b)


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    rows = []
    for i in range(700):
        v = base[i % 60] + rng.normal(size=8) * rng.choice([0.0, 0.1, 0.25])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1.0, 3.0])], int(i % 3) if i % 50 else None))
    rows += [(i, rows[7][1], rows[7][2]) for i in range(700, 900)]  # one very common vector
    odd = [None, [], [0.0] * 8, [1.0] * 7 + [None], [1.0] * 7 + [float("nan")], [float("inf")] * 8, [1.0, 2.0], [2.0, 4.0], [1e-30] * 8, [1e30] * 8]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)] + [(7, rows[7][1], rows[7][2]), (None, [1.0] * 8, 1)]
    df = spark.createDataFrame([(i, v, l, 0) for i, v, l in rows], "vec_id long, embedding array<float>, label int, copies int")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array([np.float32(y) for y in v], float)
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    units = [unit(v) if l is not None and i is not None else None for i, v, l in rows]
    count, links = [0] * len(rows), []
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.93:
                count[a] += 1
                count[b] += 1
                links.append((rows[a][0], rows[b][0]))
    root = brute.closure({i for i, _, _ in rows if i is not None}, links)
    want = sorted(((i if i is not None else -1), c, root.get(i, -1), i is not None and root[i] == i) for (i, _, _), c in zip(rows, count))
    monkeypatch.setattr(grid_join, "INTERVAL", 8 * 40)  # many intervals, many blocks
    monkeypatch.setattr(grid_join, "BLOCK", 16)
    got = grid_join.near_vectors(df).collect()
    assert sorted(((r[0] if r[0] is not None else -1), r[1], r[2] if r[2] is not None else -1, r[3]) for r in got) == want
    assert grid_join.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_of_repeated_ids_text_labels_and_doubles(spark):
    big = 1e200                                                      # beyond single precision
    rows = [(1, [1.0, 0.0], "x"), (1, [0.0, 1.0], "x"), (2, [1.0, 0.01], "x"), (3, [0.02, 1.0], "x"), (4, [1.0, 0.02], "x"), (5, [1.0, 0.0], "y"),
            (6, [big, 0.0], "z"), (7, [big, big * 1e-3], "z"), (8, [1.0, 1.0], None), (9, [3.0, 4.0], "t"), (10, [3.0 + 1e-12, 4.0], "t")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(tuple(r) for r in grid_join.near_vectors(df).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False), (4, 2, 1, False), (5, 0, 5, True), (6, 1, 6, True), (7, 1, 6, False),
                   (8, 0, 8, True), (9, 1, 9, True), (10, 1, 9, False)]
    edge = [(1, [1.0, 0.0], 1), (2, [0.93, math.sqrt(1 - 0.93 ** 2) * (1 + 1e-12)], 1), (3, [1.0, 0.0], 2), (4, [0.93, math.sqrt(1 - 0.93 ** 2) * (1 - 1e-12)], 2)]
    links = {r[0]: r[1] for r in grid_join.near_vectors(spark.createDataFrame(edge, "vec_id long, embedding array<double>, label long")).collect()}
    assert links == {1: 0, 2: 0, 3: 1, 4: 1}                         # told apart in double precision
