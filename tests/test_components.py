"""Components of the core library, and dictionary growth by components, against plain rules."""
import random

import pytest
from pyspark.sql import functions as F

from wardline.operators.connect import connected_components
from wardline.operators.fuzzy import dictionary_rounds


def closure(links):
    root = {x: x for p in links for x in p}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


@pytest.mark.parametrize("parts", [1, 13])
def test_connected_components(spark, parts):
    rng = random.Random(parts)
    links = [(f"n{i:04}", f"n{i + 1:04}") for i in range(0, 400)] + [("hub", f"h{i}") for i in range(300)] + [("self", "self"), ("b", "a"), ("a", "b")]
    links += [(f"r{rng.randrange(200)}", f"r{rng.randrange(200)}") for _ in range(90)]
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "x string, y string").repartition(parts)
    got = {r["node"]: r["component"] for r in connected_components(frame, "x", "y").collect()}
    want = closure(links)
    assert got == {k: v for k, v in want.items() if any(k in p and p[0] != p[1] for p in links)}
    assert connected_components(frame.limit(0), "x", "y").count() == 0
    numbers = spark.createDataFrame([(5, 3), (3, 9), (1, 2)], "x long, y long")
    assert {r["node"]: r["component"] for r in connected_components(numbers, "x", "y").collect()} == {5: 3, 3: 3, 9: 3, 1: 1, 2: 1}


def near(a, b):
    """Within one edit."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def sequential(names, existing=()):
    keys, out = list(existing), {}
    for n in names:
        similar = [k for k in keys if k != n and near(k, n)]
        if n in existing:
            out[n] = (n, 0, True)
        elif similar:
            out[n] = (similar[0] if len(similar) == 1 else None, len(similar), False)
        else:
            out[n] = (n, 0, True)
            keys.append(n)
    return out


def long_chain(n):
    """Names of a reflected base-8 code: each is one substitution away from the one before it."""
    names = []
    for i in range(n):
        digits, up = [], i
        for place in (512, 64, 8, 1):
            d, flip = up // place, (up // place) % 2
            digits.append(d)
            up %= place
            if flip:
                up = place - 1 - up
        names.append("name" + "".join("abcdefgh"[d] for d in digits))
    return names


@pytest.mark.parametrize("local", [100_000, 40])
def test_dictionary_by_components_equals_the_sequential_rule(spark, local):
    rng = random.Random(3)
    names = list(dict.fromkeys("".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) + f"-{i % 9}" * 3 for i in range(300)))
    existing = names[::17]
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, at long")
    got = dictionary_rounds(frame, 1, spark.createDataFrame([(e,) for e in existing], "name string"), order_col="at", local_edges=local).collect()
    want = sequential([*existing, *[n for n in names if n not in existing]], existing)
    assert {r["name"]: (r["comorb_key"], r["n_similar"], r["is_key"]) for r in got} == want


def test_a_long_chain_settles_in_few_jobs(spark):
    names = long_chain(2000)
    assert len(set(names)) == 2000 and all(near(a, b) for a, b in zip(names, names[1:]))
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, at long")
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        got = {r["name"]: r["is_key"] for r in dictionary_rounds(frame, 1, order_col="at").collect()}
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert got == {n: v[2] for n, v in sequential(names).items()}
    assert jobs < 80, jobs        # adaptive execution runs a job for each shuffle; a round per link of the chain would take thousands
