"""A1-A8 on the FIXTURES.md cases."""
import pytest
from pyspark.sql import functions as F

from wardline.operators import (AGE_TERMS, GENDER_TERMS, AnyMatch, Presence, Single, ValueEquals, classes,
                                conflict_report, entity_aggregates, entity_index, match_columns, multi_values,
                                tri_state)
from wardline.sources import Source, SourceSet


def src(spark, file, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).withColumn("_file", F.lit(file))
    return Source(df, "id", (file,))


def test_column_patterns():
    cols = ["age", "AGE", "age_years", "patient_age", "age-1", "Stage", "ageing", "percentage"]
    assert match_columns(cols, AGE_TERMS) == ["age", "AGE", "age_years", "patient_age", "age-1"]
    assert match_columns(["gender", "sex", "Sex_code", "sussex", "essex_id"], GENDER_TERMS) == ["gender", "sex", "Sex_code"]


def test_single_value_policies(spark):
    a = src(spark, "a.csv", [("1", "34"), ("1", "35"), ("2", "34"), ("3", "34"), ("4", "34"), ("5", "34"),
                             ("5", "35"), ("6", "34")], ["id", "age"])
    b = src(spark, "b.csv", [("2", "36"), ("3", "34.0"), ("4", "35"), ("6", None)], ["id", "age"])
    c = src(spark, "c.csv", [("7", "x")], ["id", "other"])
    out = entity_aggregates(SourceSet([a, b, c], "id"), {"age": Single(("age",))})
    got = {r["id"]: (r["age"], r["age__file_conflicts"], r["age__entity_conflict"]) for r in out.collect()}
    assert got["1"] == (None, 1, False)        # conflict inside the only file: entity kept, null
    assert got["2"][0] is None and got["2"][2]   # 34 vs 36 across files -> null
    assert got["3"][0] == "34.0"                # 34 and 34.0 agree
    assert got["4"][0] is None                  # 34 vs 35 across files
    assert got["5"] == (None, 1, False)
    assert got["6"][0] == "34.0"                # null ignored
    assert got["7"] == (None, 0, False)         # entity without the column still present


def test_single_value_ignore_drops_conflicting_file(spark):
    a = src(spark, "a.csv", [("1", "34"), ("1", "35")], ["id", "age"])
    b = src(spark, "b.csv", [("1", "36")], ["id", "age"])
    out = entity_aggregates(SourceSet([a, b], "id"), {"age": Single(("age",))}).collect()
    assert out[0]["age"] == "36.0"


def test_single_value_raise(spark):
    a = src(spark, "a.csv", [("1", "34"), ("2", "34")], ["id", "age"])
    b = src(spark, "b.csv", [("1", "35")], ["id", "age"])
    out = entity_aggregates(SourceSet([a, b], "id"), {"age": Single(("age",))}, conflicts="raise")
    with pytest.raises(Exception, match="Conflicting age values found for patient 1"):
        out.collect()


def test_conflict_report(spark):
    a = src(spark, "a.csv", [("1", "34"), ("1", "35"), ("2", "34")], ["id", "age"])
    b = src(spark, "b.csv", [("2", "36")], ["id", "age"])
    rep = sorted(tuple(r) for r in conflict_report(SourceSet([a, b], "id"), {"age": Single(("age",))}).collect())
    assert rep == [("1", "file", "a.csv", "age", "34.0"), ("1", "file", "a.csv", "age", "35.0"),
                   ("2", "entity", "a.csv", "age", "34.0"), ("2", "entity", "b.csv", "age", "36.0")]


def test_tri_state_sets(spark):
    rows = [("1", "neg"), ("2", "neg"), ("2", "pos"), ("3", "suspected"), ("4", "neg"), ("4", "suspected"),
            ("5", None)]
    s = src(spark, "covid_tests.csv", rows, ["id", "covid_status"])
    cl = classes(["covid"], positive=[r"\+ve", "^p$", "^pos$", "^positive$"],
                 negative=["-ve", "^n$", "^neg$", "^negative$"], suspected=["suspected"])
    out = entity_aggregates(SourceSet([s], "id"), {"covid": cl})
    out = out.select("id", tri_state(F.col("covid__positive"), F.col("covid__negative"), F.col("covid__suspected")).alias("s"))
    assert {r["id"]: r["s"] for r in out.collect()} == {"1": "N", "2": "P", "3": "U", "4": "U", "5": "U"}


def test_flags(spark):
    out_a = src(spark, "outcome_a.csv", [("1", "Died", "N"), ("2", "home", "Y")], ["id", "destination", "CRITICAL_CARE"])
    demo = src(spark, "demographics.csv", [("3", "dead", "Y")], ["id", "destination", "CRITICAL_CARE"])
    variables = {"died": AnyMatch("OUTCOME", "destination", ("dead", "died", "death")),
                 "cc_value": ValueEquals("outcome", "CRITICAL_CARE", "Y"),
                 "cc_presence": Presence("outcome")}
    got = {r["id"]: (r["died"], r["cc_value"], r["cc_presence"])
           for r in entity_aggregates(SourceSet([out_a, demo], "id"), variables).collect()}
    assert got == {"1": (1, 0, 1), "2": (0, 1, 1), "3": (0, 0, 0)}


def test_multi_values_and_index(spark):
    a = src(spark, "a.csv", [("1", "x"), ("1", "y"), ("2", None)], ["id", "covid"])
    b = src(spark, "b.csv", [("1", "x")], ["id", "covid"])
    mv = sorted((r[0], r[1] or "") for r in multi_values(SourceSet([a, b], "id"), ["covid"]).collect())
    assert mv == [("1", "x"), ("1", "y"), ("2", "")]
    idx = sorted(tuple(r) for r in entity_index(SourceSet([a, b], "id")).collect())
    assert idx == [("1", "a.csv", 2), ("1", "b.csv", 1), ("2", "a.csv", 1)]


def test_rows_without_id_belong_to_no_entity(spark):
    a = src(spark, "a.csv", [("1", "34"), (None, "99")], ["id", "age"])
    out = entity_aggregates(SourceSet([a], "id"), {"age": Single(("age",))}).collect()
    assert [(r["id"], r["age"]) for r in out] == [("1", "34.0")]
    mv = multi_values(SourceSet([a], "id"), ["age"]).collect()
    assert [tuple(r) for r in mv] == [("1", "34")]
