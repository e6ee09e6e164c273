"""F4, F10-F12, D3, P4."""
import pytest
from pyspark.sql import functions as F

from wardline.functions import (canonical_id, label_map, normalise_gender, null_tokens, regex_any, similarity,
                                split_literal, value_key)


def test_gender_forms(spark):
    df = spark.createDataFrame([(x,) for x in ["Male", "f", "0", "1", "x", "1.0", "1.7", " female ", None]], "g string")
    got = [r[0] for r in df.select(normalise_gender("g")).collect()]
    assert got == ["M", "F", "M", "F", "U", "F", "F", "F", None]


def test_gender_unmapped_number_raises(spark):
    df = spark.createDataFrame([("7",)], "g string")
    with pytest.raises(Exception, match="No gender is mapped to code"):
        df.select(normalise_gender("g")).collect()
    assert df.select(normalise_gender("g", on_unmapped="unknown")).collect()[0][0] == "U"


def test_null_tokens_and_ids(spark):
    df = spark.createDataFrame([(x,) for x in ["NA", "null", "n/a", "", " 007 ", "12.0"]], "v string")
    got = [r[0] for r in df.select(canonical_id(null_tokens("v"))).collect()]
    assert got == [None, None, None, None, "007", "12.0"]
    assert df.select(canonical_id("v", strip_float_suffix=True)).collect()[5][0] == "12"


def test_value_key_equates_numbers(spark):
    df = spark.createDataFrame([("34",), ("34.0",), (" 34 ",), ("abc",)], "v string")
    keys = [r[0] for r in df.select(value_key("v")).collect()]
    assert keys[0] == keys[1] == keys[2] and keys[3] == "abc"


def test_regex_any_is_prefix_anchored(spark):
    df = spark.createDataFrame([("Positive",), ("not positive",), ("+ve",), ("pos",)], "v string")
    got = [r[0] for r in df.select(regex_any("v", [r"\+ve", "^pos$", "^positive$"])).collect()]
    assert got == [True, False, True, True]


def test_label_map_and_split(spark):
    df = spark.createDataFrame([(0, "12 mg dl"), (5, "a.b.c")], "k int, s string")
    got = df.select(label_map("k", {0: "M", 1: "F"}).alias("m"), split_literal("s", " ").alias("sp"),
                    split_literal("s", ".").alias("dot")).collect()
    assert got[0]["m"] == "M" and got[1]["m"] is None
    assert got[0]["sp"] == ["12", "mg", "dl"]
    assert got[1]["dot"] == ["a", "b", "c"]


# Reference similarity cases against "Cancer"; its ("cancerous", 3) expectation contradicts its
# own rule (edit distance 4 > 3), so the rule wins here.
@pytest.mark.parametrize("name,threshold,expected", [
    ("Cancer", 1, 1), ("cancer", 1, 1), ("hypertension", 1, 0), ("hypertension", 2, 0),
    ("hypertension", 3, 0), ("Can-cer", 1, 1), ("cancerous", 3, 0), ("cancerous", 4, 1)])
def test_similarity(spark, name, threshold, expected):
    df = spark.createDataFrame([("Cancer", name)], "k string, x string")
    assert df.select(similarity("k", "x", threshold)).collect()[0][0] == expected
