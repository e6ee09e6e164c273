"""K1-K8, J8 and the full flow: directory of files → registry tables."""
import os

import pytest
from pyspark.sql import functions as F

from wardline.plans import Registry, apply_correction, build_events, build_patients, corrected_values, load_keyword
from wardline.sources import load_directory


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def files(workdir):
    src = os.path.join(workdir, "src")
    os.makedirs(src)
    _write(os.path.join(src, "demographics.csv"), "pid,age,gender\n007,34,Male\n2,51,1\n3,60,f\n")
    _write(os.path.join(src, "demographics_2.csv"), "pid,age_years,sex\n007,34.0,Male\n2,52,1.0\n")
    _write(os.path.join(src, "covid_tests.csv"), "pid,covid_status\n007,neg\n2,Positive\n3,suspected\n")
    _write(os.path.join(src, "outcome_events.csv"),
           "pid,event_type,date,time,destination,CRITICAL_CARE\n007,admission,1/2/2020,10:00,home,N\n"
           "2,death,3/2/2020,11:30,died,Y\n")
    return workdir, src


def test_patients_from_files(spark, files):
    _, src = files
    sources = load_directory(spark, src, "pid")
    p = {r["patient_id"]: r.asDict() for r in build_patients(sources, conflicts="ignore").collect()}
    assert p["007"] == {"patient_id": "007", "age": 34, "gender": "M", "covid": "N", "died": 0,
                        "critical_care_stay": 0}
    assert p["2"]["age"] is None and p["2"]["gender"] == "F" and p["2"]["covid"] == "P"
    assert p["2"]["died"] == 1 and p["2"]["critical_care_stay"] == 1
    assert p["3"] == {"patient_id": "3", "age": 60, "gender": "F", "covid": "U", "died": 0, "critical_care_stay": 0}
    with pytest.raises(Exception, match="Conflicting age values found for patient 2"):
        build_patients(sources, conflicts="raise").collect()


def test_registry_flow(spark, files):
    root, src = files
    sources = load_directory(spark, src, "pid")
    reg = Registry(spark, os.path.join(root, "registry")).create()
    with pytest.raises(FileExistsError):
        Registry(spark, os.path.join(root, "registry")).create()
    patients = build_patients(sources, conflicts="ignore")
    assert reg.add_patients(patients).count() == 3
    assert reg.add_patients(patients).count() == 0          # insert-if-absent
    outcome = load_keyword(sources, "outcome")
    events = build_events(outcome, "pid", ["date", "time"], {"event_type": "event_type", "destination": "destination"},
                          patients=reg.read("patients"))
    reg.append("events", events)
    assert reg.read("events").count() == 2
    docs = {r["patient_id"]: r["n_events"] for r in reg.documents().collect()}
    assert docs == {"007": 1, "2": 1, "3": 0}
    reg.delete_where("events", "event_type = 'death'")                 # pull a child (K6)
    assert {r["patient_id"]: r["n_events"] for r in reg.documents().collect()} == {"007": 1, "2": 0, "3": 0}
    reg.delete_patients(spark.createDataFrame([("2",)], "patient_id string"))
    assert sorted(r[0] for r in reg.read("patients").collect()) == ["007", "3"]
    assert [r[0] for r in reg.read("events").collect()] == ["007"]
    assert reg.read("audit").where(F.col("op") == "delete").count() == 1
    bad = spark.createDataFrame([("9", "X")], "patient_id string, gender string")
    with pytest.raises(Exception, match="Invalid gender in patients: X"):
        reg.append("patients", bad)
    assert reg.read("patients").count() == 2               # nothing committed


def test_age_correction(spark, files):
    root, src = files
    sources = load_directory(spark, src, "pid")
    fixed = corrected_values(sources, lambda c: F.max(c.cast("double")))
    got = {r[0]: r[1] for r in fixed.collect()}
    assert got == {"007": 34.0, "2": 52.0, "3": 60.0}
    from wardline.plans import python_correction

    by_python = corrected_values(sources, python_correction(lambda ages: max(float(a) for a in ages)))
    assert {r[0]: r[1] for r in by_python.collect()} == got
    plain = corrected_values(sources, max, kind="python")   # a plain list function
    assert {r[0]: r[1] for r in plain.collect()} == got
    out = apply_correction(sources, fixed)
    demo = [s for s in out if "age" in s.df.columns][0].df
    assert sorted((r["pid"], r["age"]) for r in demo.collect()) == [("007", "34.0"), ("2", "52.0"), ("3", "60.0")]


def test_loader_workflow(spark, files):
    from wardline.plans import Loader

    root, src = files
    _write(os.path.join(src, "measurements.csv"), "pid,date,hb,flag,src\n007,1/2/2020 09:00,13.5,ok,lab\n2,2/2/2020,9.1,low,ward\n")
    _write(os.path.join(src, "comorbidities.csv"), "pid,Cancer,Cancers,Asthma\n007,1,0,1\n2,0,1,0\n3,0,0,0\n")
    _write(os.path.join(src, "critical_care.csv"), "pid,admitted,discharged,days,vent\n2,2/2/2020 12:00,1/30/2020,3,Y\n")
    loader = Loader(spark, src, "pid", os.path.join(root, "reg"), conflicts="ignore")
    assert loader.add_patients(log_conflicts=True).count() == 3
    conflicts = loader.registry.read("audit").where("op = 'conflict'").collect()
    assert {r["entity_id"] for r in conflicts} == {"2"} and len(conflicts) == 2   # age 51 vs 52
    loader.add_events(["date", "time"], "outcome", {"event_type": "event_type", "destination": "destination"},
                      exclude_columns=["CRITICAL_CARE"])
    loader.add_measurements("measurements", "date", ["hb", "flag"], ["continuous", "discrete"], [[12, 16]],
                            request_source="src")
    loader.add_comorbidities("comorbidities", edit_threshold=1, conflicts="merge")
    loader.add_critical_care("critical_care", "admitted", "discharged", icu_days="days", ventilated="vent")
    reg = loader.registry
    assert reg.read("events").count() == 2
    assert reg.read("measurements").count() == 4
    assert sorted(tuple(r) for r in reg.read("comorbidities").collect()) == [("007", "Asthma"), ("007", "Cancer"),
                                                                           ("2", "Cancer")]
    assert sorted(r[0] for r in reg.read("comorb_key").collect()) == ["Asthma", "Cancer"]
    cc = reg.read("critical_care").collect()[0]
    assert cc["discharge_date"] is None and cc["admission_time"] == 720.0
    assert reg.read("audit").where("op = 'add_patient'").count() == 3
    # a second comorbidity load links to the existing keys and adds nothing twice
    loader.add_comorbidities("comorbidities", edit_threshold=1, conflicts="merge")
    assert reg.read("comorbidities").count() == 3
    rep = loader.conflicts_report({"age": ["(?:.*[._-])?age(?:[._-].*)?$"]})
    assert {r["patient_id"] for r in rep.collect()} == {"2"}


def test_loader_age_correction_writes_new_folder(spark, files):
    from wardline.plans import Loader

    root, src = files
    loader = Loader(spark, src, "pid", os.path.join(root, "reg2"), conflicts="ignore")
    target = os.path.join(root, "corrected")
    loader.age_correction(lambda ages: F.max(ages.cast("double")), new_path=target)
    back = spark.read.option("header", True).csv(os.path.join(target, "*", "_file=demographics.csv"))
    assert sorted((r["pid"], r["age"]) for r in back.collect()) == [("007", "34.0"), ("2", "52.0"), ("3", "60.0")]
    with open(os.path.join(src, "demographics.csv")) as f:      # inputs untouched
        assert "51" in f.read()
    # the corrected sources now drive the patient build
    p = {r["patient_id"]: r["age"] for r in loader.add_patients().collect()}
    assert p == {"007": 34, "2": 52, "3": 60}
