"""The bucketed registry: same results, and stored rows that are not shuffled."""
import re

import pytest
from pyspark.sql import functions as F

from wardline.operators.validate import missing_parents
from wardline.plans import BucketedRegistry, Registry


def events(spark, n, hot=3):
    return spark.range(n).select(F.when(F.col("id") % hot == 0, "p0").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("patient_id"),
                                 F.concat(F.lit("e"), F.col("id")).alias("event_type"), F.to_date(F.lit("2024-01-01")).alias("event_date"))


def filled(spark, reg):
    reg.create()
    reg.add_patients(spark.range(500).select(F.concat(F.lit("p"), "id").alias("patient_id"), F.col("id").cast("int").alias("age")))
    reg.append("events", events(spark, 3000))
    reg.append("events", events(spark, 300).withColumn("event_type", F.concat(F.lit("late"), "event_type")))
    return reg


def shown(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_equals_the_plain_registry(spark, workdir):
    plain, bucketed = filled(spark, Registry(spark, f"{workdir}/a")), filled(spark, BucketedRegistry(spark, f"{workdir}/b", 8, 4))
    for step in (lambda r: None, lambda r: r.add_patients(spark.createDataFrame([("p3", 99), ("new", 1)], "patient_id string, age int")),
                 lambda r: r.delete_patients(spark.createDataFrame([("p0",), ("p77",), ("nobody",)], "patient_id string")),
                 lambda r: r.delete_where("events", "event_type like 'late%'"), lambda r: r.append("events", events(spark, 20))):
        for r in (plain, bucketed):
            step(r)
        for table in ("patients", "events", "comorbidities"):
            assert shown(bucketed.read(table)) == shown(plain.read(table))
            assert bucketed.read(table).columns == plain.read(table).columns
        assert shown(bucketed.documents()) == shown(plain.documents())
    assert bucketed.read("events").count() > 0
    # Another session knows none of the tables: they are found again by their folder.
    for t in spark.catalog.listTables():
        if t.name.startswith("wardline_"):
            spark.sql(f"drop table {t.name}")
    again = BucketedRegistry(spark, f"{workdir}/b", 99, 99)
    assert (again.buckets, again.parts) == (8, 4) and shown(again.read("events")) == shown(plain.read("events"))
    with pytest.raises(ValueError, match="without buckets"):
        BucketedRegistry(spark, f"{workdir}/a")


def sides(df):
    """For each scan of a stored table in the plan: whether an exchange lies between it and the join."""
    plan = df._jdf.queryExecution().sparkPlan().toString() and df._jdf.queryExecution().executedPlan().toString()
    lines, found = plan.split("\n"), []
    for i, line in enumerate(lines):
        if "wardline_" in line and "FileScan" in line:
            depth, above = line.index("FileScan"), []
            for up in reversed(lines[:i]):
                at = re.search(r"[A-Za-z]", up.lstrip(" :+-"))
                pos = len(up) - len(up.lstrip(" :+-")) if at else 0
                if pos < depth:
                    depth = pos
                    above.append(up)
                if "Join" in up and pos <= depth:
                    break
            found.append((any("Exchange" in a for a in above), "Bucketed: true" in line))
    return found


def test_stored_side_is_not_shuffled(spark, workdir):
    reg = filled(spark, BucketedRegistry(spark, f"{workdir}/b", 8, 4))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(900).select(F.concat(F.lit("p"), "id").alias("patient_id"))
        doomed = ids.limit(50).checkpoint()
        for joined in (ids.join(reg.read("patients").select("patient_id"), "patient_id", "left_anti"),       # insert-if-absent
                       missing_parents(ids, reg.read("patients"), "patient_id", registered=True),                             # parent check
                       reg._keep("patients", doomed), reg._keep("events", doomed)):                          # delete
            assert sides(joined) == [(False, True)], joined._jdf.queryExecution().executedPlan().toString()
        assert reg._keep("events", doomed).count() == reg.read("events").join(doomed, "patient_id", "left_anti").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_patient_lies_in_several_buckets(spark, workdir):
    reg = filled(spark, BucketedRegistry(spark, f"{workdir}/b", 16, 8))
    files = reg.read("events").where("patient_id = 'p0'").groupBy(F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1).alias("bucket")).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) < 0.6 * sum(r["count"] for r in files)
