"""Incremental and streaming resolution equal the one-shot rebuild."""
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from wardline.operators.resolve import AnyMatch, Presence, Single, classes, entity_aggregates
from wardline.plans import Loader, ResolvedStore
from wardline.sources import SourceSet, from_table
from wardline.streaming import resolve_stream

VARIABLES = {"age": Single(("^age",)), "status": classes(["^status"], pos=["^p"], neg=["^n"]), "died": AnyMatch("out", "place", ("dead",)),
             "seen": Presence("out")}
COLS = "pid string, f string, age string, status string, place string"


def rows_of(seed, n=300):
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice([*xs, None])
    ids = ["hot"] * 10 + [f"p{i}" for i in range(25)] + [None]
    return [(rng.choice(ids), f"{rng.choice(['out', 'in'])}{rng.randint(1, 6)}", pick("34", "34.0", "35", " 34 "), pick("pos", "neg", "x"), pick("dead", "home")) for _ in range(n)]


def sources(spark, rows):
    return SourceSet([from_table(spark.createDataFrame(rows, COLS), "patient_id", source_id="pid", file_column="f")])


def shown(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_drops_in_any_order_equal_one_load(spark, workdir, seed):
    rows, rng = rows_of(seed), random.Random(seed)
    files = sorted({r[1] for r in rows})
    rng.shuffle(files)
    store = ResolvedStore(spark, f"{workdir}/store", VARIABLES, buckets=5)
    seen, before = [], {}
    for some in (files[:5], files[5:6], files[6:9], files[9:]):
        part = [r for r in rows if r[1] in some]
        changed = store.add(sources(spark, part))
        seen += part
        assert shown(store.current()) == shown(entity_aggregates(sources(spark, seen), VARIABLES, id_alias="patient_id"))
        after = {r["patient_id"]: tuple(r) for r in store.current().collect()}
        want = {i: ("insert" if i not in before else "update") for i in after if before.get(i) != after[i]}
        assert {r["patient_id"]: r["change"] for r in changed.collect()} == want
        before = after
    # A state repeated, as of a file that is delivered again under another number, changes nothing.
    assert store.add(sources(spark, rows[:50]), 99).count() == 0
    assert store.compact() == 100 and {r["patient_id"]: tuple(r) for r in store.current().collect()} == before
    more = [("hot", "later", "77", None, None), ("new", "later", "1", "pos", None)]
    assert {r["patient_id"] for r in store.add(sources(spark, more)).collect()} >= {"new"}
    assert shown(store.current()) == shown(entity_aggregates(sources(spark, rows + more), VARIABLES, id_alias="patient_id"))


def test_replay_and_unfinished_drop(spark, workdir):
    store = ResolvedStore(spark, f"{workdir}/store", VARIABLES, buckets=3)
    store.add(sources(spark, [("a", "in1", "30", None, None)]), 1)
    spark.range(3).withColumn("_id", F.lit("a")).write.parquet(f"{workdir}/store/states/drop=2")      # a job that died: no decision
    assert store.drops() == [1]
    first = shown(store.add(sources(spark, [("a", "in2", "31", None, None)]), 2))
    assert first[0][-1] is not None and store.current().first()["age"] is None and store.current().first()["age__entity_conflict"]
    assert shown(store.add(sources(spark, [("zzz", "in2", "1", None, None)]), 2)) == first           # drop 2 counts already
    assert store.current().count() == 1
    with pytest.raises(ValueError, match="other variables"):
        ResolvedStore(spark, f"{workdir}/store", {"age": Single(("x",))})
    assert ResolvedStore(spark, f"{workdir}/store", VARIABLES, buckets=99).buckets == 3
    empty = ResolvedStore(spark, f"{workdir}/empty", VARIABLES)
    assert empty.current().count() == 0 and empty.add(sources(spark, [(None, "in1", "3", None, None)])).count() == 0
    with pytest.raises(Exception, match="Conflicting age"):
        ResolvedStore(spark, f"{workdir}/strict", VARIABLES, conflicts="raise").add(sources(spark, [("a", "in1", "1", None, None), ("a", "in2", "2", None, None)]))


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_loader_reads_new_files_only(spark, workdir):
    folder = f"{workdir}/extracts"
    write(folder, "demographics.csv", "pid,age,sex\n1,34,m\n2,50,f\n3,60,f\n")
    write(folder, "more.csv", "pid,age,sex\n2,51,f\n")
    options = dict(critical_care_presence_infers_positivity=True)
    update = lambda: Loader(spark, folder, "pid", f"{workdir}/registry", conflicts="ignore").update_patients(f"{workdir}/store", **options)
    assert {(r["patient_id"], r["age"], r["change"]) for r in update().collect()} == {("1", 34, "insert"), ("2", None, "insert"), ("3", 60, "insert")}
    assert update().count() == 0
    write(folder, "outcome_9.csv", "pid,age,destination\n3,60,Died in hospital\n4,9,home\n1,35,home\n")
    # Whatever the old files hold now: they are not opened again.
    write(folder, "demographics.csv", "pid,age,sex\n1,99,m\nnot read,1,f\n")
    changed = update()
    assert {(r["patient_id"], r["age"], r["died"], r["critical_care_stay"], r["change"]) for r in changed.collect()} == {
        ("1", None, 0, 1, "update"), ("3", 60, 1, 1, "update"), ("4", 9, 0, 1, "insert")}
    assert all("/store/" in f for f in changed.inputFiles())
    with pytest.raises(ValueError, match="loaded before"):
        loader = Loader(spark, folder, "pid", f"{workdir}/registry", conflicts="ignore")
        from wardline.plans import patient_rules
        variables, basics = patient_rules(**options)
        ResolvedStore(spark, f"{workdir}/store", variables, basics).add(loader.sources)


def test_only_touched_buckets_are_read(spark, workdir):
    store = ResolvedStore(spark, f"{workdir}/store", VARIABLES, buckets=40)
    store.add(sources(spark, [(f"p{i}", "in1", "30", None, None) for i in range(300)]))
    scanned = store._read("states", store._state_schema(spark.read.parquet(f"{workdir}/store/states/drop=1")), [1]).where(F.col("bucket").isin([7]))
    assert 0 < scanned.count() < 30
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", scanned._jdf.queryExecution().toString())


def test_stream_equals_batch_also_after_a_restart(spark, workdir):
    rows = rows_of(7, 400)
    drop, ckpt = f"{workdir}/drop", f"{workdir}/ckpt"
    schema = spark.createDataFrame(rows[:1], COLS).schema

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(drop)
        query = resolve_stream(from_table(stream, "patient_id", source_id="pid", file_column="f"),
                               ResolvedStore(spark, f"{workdir}/store", VARIABLES, buckets=4), ckpt)
        query.awaitTermination(180)
        assert query.exception() is None

    store = ResolvedStore(spark, f"{workdir}/store", VARIABLES, buckets=4)
    for i, part in enumerate((rows[:150], rows[150:250])):
        spark.createDataFrame(part, COLS).coalesce(1).write.mode("append").parquet(drop)
    run()
    assert len(store.drops()) >= 2
    assert shown(store.current()) == shown(entity_aggregates(sources(spark, rows[:250]), VARIABLES, id_alias="patient_id"))
    spark.createDataFrame(rows[250:], COLS).coalesce(1).write.mode("append").parquet(drop)
    late = [("p1", "in3", "11", None, None), ("p1", "in3", "12", None, None), ("fresh", "in9", "40", None, None)]
    spark.createDataFrame(late, COLS).coalesce(1).write.mode("append").parquet(drop)
    run()                                                   # a restart: the checkpoint remembers files and states
    assert shown(store.current()) == shown(entity_aggregates(sources(spark, rows + late), VARIABLES, id_alias="patient_id"))
    changes = {(r["patient_id"], r["change"]) for n in store.drops() for r in store.changes(n).collect()}
    assert ("fresh", "insert") in changes and sum(i == "hot" and c == "insert" for i, c in changes) == 1
