"""Exact similarity join and order-dependent dictionary growth."""
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardline.operators import resolve_names, similar_pairs


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def greedy(names, t, existing=()):
    """Sequential reference: one name at a time, in order."""
    keys = list(existing)
    out = {}
    for n in sorted(set(names) - set(existing)):
        sim = [k for k in keys if lev(k, n) <= t]
        if not sim:
            keys.append(n)
        out[n] = (n if not sim else (sim[0] if len(sim) == 1 else None), len(sim))
    return out


def names_df(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


@pytest.mark.parametrize("alphabet,t", [("abc", 0), ("abc", 1), ("abc", 2), ("ab", 3), ("abcd", 4), ("ab", 4)])
def test_pairs_exact_against_brute_force(spark, alphabet, t):
    rnd = random.Random(7 + t)
    names = list({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9))) for _ in range(90)})
    got = {(r["name_a"], r["name_b"], r["distance"]) for r in similar_pairs(names_df(spark, names), t).collect()}
    exp = {(a, b, lev(a, b)) for a in names for b in names if a < b and lev(a, b) <= t}
    assert got == exp


def test_order_matters(spark):
    r = {x["name"]: (x["comorb_key"], x["n_similar"], x["action"])
         for x in resolve_names(names_df(spark, ["abd", "abc", "abe"]), 1, conflicts="merge").collect()}
    assert r == {"abc": ("abc", 0, "new_key"), "abd": ("abc", 1, "merged"), "abe": ("abc", 1, "merged")}


def test_ambiguous_name(spark):
    existing = names_df(spark, ["aa", "bb"])
    r = {x["name"]: (x["comorb_key"], x["action"])
         for x in resolve_names(names_df(spark, ["ab", "aa"]), 1, existing=existing, conflicts="merge").collect()}
    assert r == {"ab": (None, "dropped"), "aa": ("aa", "existing")}
    with pytest.raises(ValueError, match="ab"):
        resolve_names(names_df(spark, ["ab"]), 1, existing=existing, conflicts="raise")


def test_ignore_policies(spark):
    r = {x["name"]: x["action"] for x in resolve_names(names_df(spark, ["abc", "abd"]), 1, conflicts="ignore").collect()}
    assert r == {"abc": "new_key", "abd": "skipped"}
    doc = {x["name"]: x["comorb_key"] for x in
           resolve_names(names_df(spark, ["abc", "abd"]), 1, conflicts="ignore", policy="document").collect()}
    assert doc == {"abc": "abc", "abd": "abd"}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abcd", min_size=1, max_size=5), min_size=1, max_size=25), st.integers(1, 2))
def test_rounds_equal_sequential(spark, names, t):
    got = {x["name"]: (x["comorb_key"], x["n_similar"])
           for x in resolve_names(names_df(spark, names), t, conflicts="merge").collect()}
    assert got == greedy(names, t)


@pytest.mark.parametrize("t", [1, 3])
def test_variants_and_segments_are_not_broadcast(spark, t):
    """exploded rows are many times what their names are; a small table must not make the driver hold them."""
    pairs = similar_pairs(names_df(spark, [f"Customer#{i:09d}" for i in range(50)]), t)
    assert pairs.count() > 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
