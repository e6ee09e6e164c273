"""Pages of nested documents, and user aggregates that merge, against plain models."""
import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wardline.operators import UserAggregate, aggregate_by
from wardline.plans import corrected_values, numbered_children, patient_pages
from wardline.sources import SourceSet, from_table

CHILD = "patient_id string, child string, name string, date date, time double, value string"


def children_of(seed, n=600):
    rng = random.Random(seed)
    ids = ["hot"] * 12 + [f"p{i}" for i in range(20)] + [None]
    day = lambda: rng.choice([None, *[dt.date(2020, 1, 1 + i) for i in range(9)]])
    return [(rng.choice(ids), rng.choice(["event", "stay"]), rng.choice("abc"), day(), rng.choice([None, 1.0, 2.5]), rng.choice([None, "x", "y"])) for _ in range(n)]


def ordered(rows):
    first = lambda v: (v is not None, v)
    return sorted(rows, key=lambda r: (first(r[3]), first(r[4]), r[1], r[2], first(r[5])))


@pytest.mark.parametrize("ranges", [1, 7])
def test_pages_equal_slices_of_the_sorted_history(spark, ranges):
    rows = children_of(3) + [("same", "event", "a", None, None, None)] * 40
    got = patient_pages(spark.createDataFrame(rows, CHILD), page_size=9, ranges=ranges).collect()
    want = {}
    for pid in {r[0] for r in rows if r[0]}:
        mine = ordered([r for r in rows if r[0] == pid])
        for i in range(0, len(mine), 9):
            want[pid, i // 9 + 1] = (i + 1, mine[i:i + 9])
    assert len(got) == len(want)
    for r in got:
        first, part = want[r["patient_id"], r["page"]]
        assert (r["first_position"], r["n_children"]) == (first, len(part))
        assert [(r["patient_id"], c["child"], c["name"], c["date"], c["time"], c["value"]) for c in r["children"]] == part
        dates = [p[3] for p in part if p[3]]
        assert (r["first_date"], r["last_date"]) == ((min(dates), max(dates)) if dates else (None, None))


def test_a_hot_patient_lies_in_many_ranges(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("patient_id"),
                                    F.lit("event").alias("child"), F.lit("a").alias("name"), F.lit(None).cast("date").alias("date"),
                                    F.lit(None).cast("double").alias("time"), F.lit(None).cast("string").alias("value"))
    plan = numbered_children(df, ranges=12)
    hot = plan.where("patient_id = 'hot'").select("position").collect()       # all its rows are equal: only the tie key spreads them
    assert sorted(r["position"] for r in hot) == list(range(1, 10_001))
    pages = patient_pages(df, page_size=500, ranges=12).where("patient_id = 'hot'").collect()
    assert len(pages) == 20 and all(r["n_children"] == 500 for r in pages)
    parts = df.withColumn("k", F.xxhash64("id") if "id" in df.columns else F.xxhash64(F.monotonically_increasing_id()))
    spread = parts.repartitionByRange(12, "patient_id", "k").where("patient_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 4 and max(r["count"] for r in spread) < 4000
    assert patient_pages(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        patient_pages(df, 0)
    with pytest.raises(ValueError, match="added here"):
        numbered_children(df.withColumn("position", F.lit(1)))


def spread():
    class Spread(UserAggregate):
        """A list of states would show every merge; count, sum and a set are enough to tell a lost or doubled one."""

        def zero(self):
            return (0, 0.0, frozenset())

        def reduce(self, state, values):
            return (state[0] + len(values), state[1] + sum(values), state[2] | set(values))

        def merge(self, a, b):
            return (a[0] + b[0], a[1] + b[1], a[2] | b[2])

        def finish(self, state):
            return None if state[1] < 0 else state[0] * 1e6 + state[1] + len(state[2]) / 1e4

    return Spread()      # a class of a function travels to the tasks by value


@pytest.mark.parametrize("fan_in", [2, 64])
def test_states_merge_in_rounds(spark, fan_in):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 9 + list("abcd") + [None]), rng.choice([None, 1.0, 2.0, 5.0])) for _ in range(900)] + [("minus", -5.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(40)    # 40 tasks: 40 states of the hot key
    got = {r["k"]: r["out"] for r in aggregate_by(df, "k", "v", spread(), alias="out", fan_in=fan_in).collect()}
    want = {}
    for k in {k for k, v in rows if k and v is not None}:
        mine = [v for i, v in rows if i == k and v is not None]
        want[k] = spread().finish((len(mine), sum(mine), frozenset(mine)))
    assert got == pytest.approx(want) and got["minus"] is None
    assert aggregate_by(df.limit(0), "k", "v", spread()).count() == 0


def test_states_merge_by_batches_of_keys(spark):
    """no Python call and no frame for each key."""
    df = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 9_000).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    out = aggregate_by(df, "k", "v", spread(), alias="out")
    assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 9_000 and out.where("out is null").count() == 0


def test_correction_by_a_user_aggregate_has_no_limit(spark):
    df = spark.range(250_000).select(F.when(F.col("id") < 200_000, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("pid"), (F.col("id") % 199_999).alias("age"))
    sources = SourceSet([from_table(df, "patient_id", source_id="pid", file="ages")])
    middle = UserAggregate(zero=list, reduce=lambda s, v: s + [(min(v), max(v))], merge=lambda a, b: [(min(x[0] for x in a + b), max(x[1] for x in a + b))],
                           finish=lambda s: statistics.mean(s[0]) if s else None)
    got = {r["patient_id"]: r["corrected"] for r in corrected_values(sources, middle, ["^age$"]).collect()}
    want = {r["pid"]: r["m"] for r in df.groupBy("pid").agg(((F.min("age") + F.max("age")) / 2).alias("m")).collect()}
    assert got == want and len(got) == 51
