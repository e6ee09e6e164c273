"""X1-X7, R1, R2, P13 on small frames."""
import pytest
from pyspark.sql import functions as F

from wardline.plans import (build_comorbidities, build_critical_care, build_events, build_measurements,
                            measurements_of_type)


def test_events(spark):
    df = spark.createDataFrame([("1", " admission ", "15/3/2020", "14:30", "Y", "x1"),
                                ("2", "death", "16/3/2020", None, "N", "x2")],
                               "id string, type string, d string, t string, cc string, other string")
    patients = spark.createDataFrame([("1",), ("2",)], "patient_id string")
    ev = build_events(df, "id", ["d", "t"], {"event_type": "type"}, exclude_columns=["cc"], patients=patients)
    rows = {r["patient_id"]: r for r in ev.collect()}
    assert rows["1"]["event_type"] == "admission" and rows["1"]["event_time"] == 870.0
    assert rows["2"]["event_time"] is None and str(rows["2"]["event_date"]) == "2020-03-16"
    assert rows["1"]["covid_status"] == "U" and rows["1"]["death"] == 0
    assert rows["1"]["extra"] == {"other": "x1"}


def test_events_invalid_date_and_unknown_parent(spark):
    df = spark.createDataFrame([("1", "x", "1/30/2020")], "id string, type string, d string")
    with pytest.raises(Exception, match="Invalid event datetime for patient 1"):
        build_events(df, "id", "d", {"event_type": "type"}).collect()
    patients = spark.createDataFrame([("2",)], "patient_id string")
    with pytest.raises(ValueError, match="patient_id=1"):
        build_events(df, "id", "d", {"event_type": "type"}, patients=patients)
    with pytest.raises(AssertionError):
        build_events(df, "id", "d", {"component": "type"})


def test_measurements(spark):
    df = spark.createDataFrame([("1", "5.5", "pos", "12 mg dl", "15/3/2020 10:00", "lab", "H, repeat", "fasting")],
                               "id string, hb string, flag string, cx string, dt string, src string, fl string, nt string")
    m = build_measurements(df, "id", ["hb", "flag", "cx"], ["continuous", "discrete", "complex"],
                           result_datetime="dt", ref_ranges=[[1, 10]], request_source="src", notes="nt", flags="fl")
    rows = {r["result_name"]: r for r in m.collect()}
    assert rows["hb"]["result_double"] == 5.5 and rows["hb"]["ref_range"] == [1.0, 10.0]
    assert rows["flag"]["result_string"] == "pos" and rows["flag"]["ref_range"] is None
    assert rows["cx"]["result_array"] == ["12", "mg", "dl"]
    assert rows["cx"]["result_time"] == 600.0 and rows["cx"]["request_source"] == "lab"
    assert rows["hb"]["flags"] == ["H", "repeat"] and rows["hb"]["notes"] == "fasting"
    sub = measurements_of_type(m, "continuous").collect()
    assert len(sub) == 1 and sub[0]["result"] == 5.5
    bad = spark.createDataFrame([("1", "abc")], "id string, hb string")
    with pytest.raises(Exception, match="not a number"):
        build_measurements(bad, "id", ["hb"], ["continuous"]).collect()
    assert build_measurements(bad, "id", ["hb"], ["continuous"], on_invalid="drop").count() == 0
    with pytest.raises(AssertionError):
        build_measurements(bad, "id", ["hb"], ["continuous", "discrete"])


def test_critical_care_invalid_dates_become_null(spark):
    df = spark.createDataFrame([("1", "1/30/2020", "16/3/2020 08:00", "3", "Y")],
                               "id string, a string, d string, days string, v string")
    r = build_critical_care(df.withColumn("ward", df.v), "id", "a", "d", icu_days="days", ventilated="v",
                            keep_extra=True).collect()[0]
    assert r["extra"] == {"ward": "Y"}
    assert r["admission_date"] is None and str(r["discharge_date"]) == "2020-03-16"
    assert r["discharge_time"] == 480.0 and r["icu_days"] == 3.0 and r["covid_status"] == "U"


def test_comorbidities(spark):
    df = spark.createDataFrame([("1", 1, 0, 1), ("1", 1, 0, 1), ("2", 0, 1, 1)],
                               "id string, Cancer int, Cancers int, Asthma int")
    links, keys, decisions = build_comorbidities(df, "id", edit_threshold=1, conflicts="merge")
    assert sorted(tuple(r) for r in links.collect()) == [("1", "Asthma"), ("1", "Cancer"), ("2", "Asthma"),
                                                         ("2", "Cancer")]
    assert sorted(r[0] for r in keys.collect()) == ["Asthma", "Cancer"]
    none = spark.createDataFrame([("1", 0)], "id string, Cancer int")
    with pytest.warns(UserWarning):
        assert build_comorbidities(none, "id") is None


def test_comorbidities_header_order(spark):
    # "Cancers" comes first in the header, so it becomes the key and "Cancer" merges into it.
    df = spark.createDataFrame([("1", 1, 1)], "id string, Cancers int, Cancer int")
    links, keys, _ = build_comorbidities(df, "id", edit_threshold=1, conflicts="merge")
    assert [r[0] for r in keys.collect()] == ["Cancers"]
    assert [tuple(r) for r in links.collect()] == [("1", "Cancers")]
    links, keys, _ = build_comorbidities(df, "id", edit_threshold=1, conflicts="merge", order="name")
    assert [r[0] for r in keys.collect()] == ["Cancer"]
