"""Upsert with history, presence index and reject routing against plain models."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import route_rows, table_checks
from wardline.plans import HistoryTable
from wardline.sources import PresenceIndex, SourceSet, from_table, load_directory

DAY = lambda n: dt.datetime(2024, 1, n)
SCHEMA = "patient_id string, age int, gender string, note string"


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_equal_a_plain_model(spark, workdir, seed):
    rng = random.Random(seed)
    table = HistoryTable(spark, f"{workdir}/h", SCHEMA, unknown={"gender": ["U", "?"]})
    state, states = {}, {}
    for day in range(1, 7):
        if day == 4:
            gone = rng.sample(sorted(state), 3) + ["never there"]
            written = table.delete(spark.createDataFrame([(g,) for g in gone * 2], "id string"), DAY(day), "id")
            assert sorted(r["patient_id"] for r in written.collect()) == sorted(gone[:3])
            state = {k: v for k, v in state.items() if k not in gone}
        else:
            load = [(f"p{i}", rng.choice([None, 1, 2]), rng.choice([None, "U", "M", "?", "F"]), rng.choice([None, "x"])) for i in rng.sample(range(20), 12)]
            written = table.upsert(spark.createDataFrame(load, SCHEMA), DAY(day))
            changes = {}
            for pid, *new in load:
                old = state.get(pid)
                known = [None if i == 1 and v in ("U", "?") else v for i, v in enumerate(new)]
                row = tuple(k if k is not None else (o if o is not None else n) for k, n, o in zip(known, new, old[0] if old else (None,) * 3))
                if old is None or old[0] != row:
                    changes[pid] = "update" if old else "insert"
                    state = {**state, pid: (row, DAY(day))}
            assert {r["patient_id"]: r["change"] for r in written.collect()} == changes
        states[day] = state
    plain = lambda rows: {r["patient_id"]: ((r["age"], r["gender"], r["note"]), r["valid_from"]) for r in rows.collect()}
    for day, want in states.items():
        assert plain(table.as_of(DAY(day))) == want
        assert plain(table.as_of(DAY(day) + dt.timedelta(hours=5))) == want
    assert plain(table.current()) == states[6] and plain(table.as_of(dt.datetime(2023, 1, 1))) == {}
    spans = table.history().collect()
    for day, want in states.items():      # the intervals of a key do not overlap, and hold what was valid
        valid = [r for r in spans if r["valid_from"] <= DAY(day) and (r["valid_to"] is None or DAY(day) < r["valid_to"])]
        assert {r["patient_id"] for r in valid} == set(want) and len(valid) == len(want)
    read = table.as_of(DAY(2)).inputFiles()
    assert read and all("load=1-" in f or "load=2-" in f for f in read)


def test_refused_loads(spark, workdir):
    table = HistoryTable(spark, f"{workdir}/h", SCHEMA)
    one = spark.createDataFrame([("a", 1)], "patient_id string, age int")
    assert table.upsert(one, DAY(2)).count() == 1 and table.upsert(one, DAY(3)).count() == 0      # no change, no version
    for bad, why in ((spark.createDataFrame([("b", 1), ("b", 2)], "patient_id string, age int"), "repeated"),
                     (spark.createDataFrame([(None, 1)], "patient_id string, age int"), "missing"), (one.withColumn("extra", F.lit(1)), "does not have")):
        with pytest.raises(ValueError, match=why):
            table.upsert(bad, DAY(9))
    with pytest.raises(ValueError, match="must come after"):
        table.upsert(one, DAY(3))
    with pytest.raises(ValueError, match="key"):
        HistoryTable(spark, f"{workdir}/x", "id string")
    one.write.parquet(f"{workdir}/h/load=3-at-20240109000000000000/_left_behind")                  # no marker: does not count
    assert [n for n, _ in table.loads()] == [1, 2]
    assert table.delete(one.select("patient_id"), DAY(10)).count() == 1 and table.current().count() == 0
    assert [r["change"] for r in table.upsert(one.withColumn("age", F.lit(None).cast("int")), DAY(11)).collect()] == ["insert"]
    assert table.current().first()["age"] is None                                                  # old values stay deleted


def test_presence_opens_only_files_that_can_hold_an_id(spark, workdir):
    rows = spark.range(4000).select(F.concat(F.lit("p"), F.col("id")).alias("pid"), (F.col("id") % 7).alias("v"))
    rows.repartitionByRange(10, "pid").write.option("header", True).csv(f"{workdir}/extracts")
    sources = load_directory(spark, f"{workdir}/extracts", "pid")
    files = {f for s in sources for f in s.files}
    index = PresenceIndex(spark, f"{workdir}/index", bits=18)
    index.add(sources)
    index.add(sources)                                                                             # indexed already: nothing is added
    assert index.files() == files and index.read().groupBy("_file", "block").count().where("count > 1").count() <= len(files)
    ids = spark.createDataFrame([(" p17 ",), ("p2500",), ("nobody",), (None,), ("p17",)], "i string")
    found = index.lookup(sources, ids)
    assert sorted(r["pid"] for s in found for r in s.df.collect()) == ["p17", "p2500"]
    opened = {f for s in found for f in s.files}
    holding = {r["_file"] for s in sources for r in s.df.where(F.col("pid").isin("p17", "p2500")).select("_file").collect()}
    assert holding <= opened and len(opened) <= 4 < len(files)
    plan = next(iter(found)).df
    assert {f.rpartition("/")[2] for f in plan.inputFiles() if "extracts" in f} == opened
    many = spark.range(4000).select(F.concat(F.lit("p"), F.col("id")).alias("i"))
    assert sum(s.df.count() for s in index.lookup(sources, many)) == 4000                          # never a false negative
    assert len(index.lookup(sources, ids.where("i = 'nobody'"))) <= 1
    with pytest.raises(ValueError, match="other bits"):
        PresenceIndex(spark, f"{workdir}/index", bits=20).candidates(ids)
    with pytest.raises(ValueError, match="list their files"):
        index.add(SourceSet([from_table(rows.withColumn("f", F.lit("x")), "patient_id", source_id="pid", file_column="f")]))


def test_a_new_file_is_indexed_and_an_unindexed_one_read(spark, workdir):
    import os

    os.makedirs(f"{workdir}/in")
    for name, body in (("a.csv", "pid,x\n1,2\n"), ("b.csv", "pid,x\n,5\n")):                        # b holds no id at all
        with open(f"{workdir}/in/{name}", "w") as f:
            f.write(body)
    index = PresenceIndex(spark, f"{workdir}/index")
    index.add(load_directory(spark, f"{workdir}/in", "pid"))
    with open(f"{workdir}/in/c.csv", "w") as f:
        f.write("pid,x\n1,9\n7,9\n")
    sources, ids = load_directory(spark, f"{workdir}/in", "pid"), spark.createDataFrame([("1",)], "i string")
    values = lambda: sorted(r["x"] for s in index.lookup(sources, ids) for r in s.df.collect())
    assert index.files() == {"a.csv", "b.csv"} and values() == ["2", "9"]
    index.add(sources)
    assert index.files() == {"a.csv", "b.csv", "c.csv"} and values() == ["2", "9"]


def test_rows_are_routed_in_one_scan(spark, workdir):
    rows = [("1", "adm", "2024-01-01", "P", 1), (None, "adm", None, "X", 2), ("2", None, "2024-01-02", None, 3), ("3", "adm", "2024-01-03", "x", 4)]
    df = spark.createDataFrame(rows, "patient_id string, event_type string, event_date string, covid_status string, n int")
    checks = table_checks("events", df.columns)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    accepted, rejected, counts = route_rows(df.mapInPandas(counted, df.schema), checks, f"{workdir}/routed")
    assert seen.value == len(rows)
    assert [r["n"] for r in accepted.collect()] == [1] and accepted.columns == df.columns
    assert {r["n"]: r["reasons"] for r in rejected.collect()} == {
        2: ["missing patient_id", "missing event_date", "invalid covid_status"], 3: ["missing event_type"], 4: ["invalid covid_status"]}
    assert counts == {"accepted": 1, "rejected": 3, "missing patient_id": 1, "missing event_type": 1, "missing event_date": 1, "invalid covid_status": 2,
                      **{k: 0 for k in checks if k not in ("missing patient_id", "missing event_type", "missing event_date", "invalid covid_status")}}
    a, r, c = route_rows(df.limit(0), checks, f"{workdir}/none")
    assert a.count() == r.count() == c["accepted"] == 0
    assert route_rows(df, {}, f"{workdir}/all")[0].count() == 4
    with pytest.raises(ValueError, match="added here"):
        route_rows(df.withColumn("reasons", F.lit(1)), checks, f"{workdir}/clash")
