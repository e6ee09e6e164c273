"""Property tests: datetime round trips and validation helpers."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardline.functions import with_parsed_datetime
from wardline.operators import duplicate_keys, invalid_choices, missing_required
from wardline.plans import cascade_delete, insert_if_absent, patient_documents

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def layouts(t: dt.datetime):
    """(text, expected minutes) in each accepted layout."""
    h12 = t.hour % 12 or 12
    ampm = "am" if t.hour < 12 else "pm"
    minutes = float(t.hour * 60 + t.minute)
    return [
        (f"{t.day}/{t.month}/{t.year}", None),
        (f"{t.day:02d}.{t.month:02d}.{t.year} {t.hour:02d}:{t.minute:02d}", minutes),
        (f"{t.day}-{t.month}-{t.year % 100:02d} {t.hour}:{t.minute:02d}:{t.second:02d}", minutes),
        (f"{t.day}/{t.month}/{t.year} {h12}:{t.minute:02d}{ampm}", minutes),
        (f"{t.year}-{t.month:02d}-{t.day:02d}T{t.hour:02d}:{t.minute:02d}:{t.second:02d}", minutes),
        (f"{t.day} {MONTHS[t.month - 1]} {t.year}", None),
        (f"{t.day} {t.strftime('%B')} {t.year} {t.hour:02d}:{t.minute:02d}", minutes),
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2099, 12, 31)),
                min_size=1, max_size=40))
def test_datetime_round_trip(spark, stamps):
    rows, expected = [], {}
    for i, t in enumerate(stamps):
        for j, (text, minutes) in enumerate(layouts(t)):
            rows.append((i * 10 + j, text))
            expected[i * 10 + j] = (t.date(), minutes)
    df = with_parsed_datetime(spark.createDataFrame(rows, "k int, t string"), "t", "d", "m")
    got = {r["k"]: (r["d"], r["m"]) for r in df.collect()}
    assert got == expected


def test_validation_helpers(spark):
    df = spark.createDataFrame([("1", "M"), ("1", "X"), (None, "F")], "patient_id string, gender string")
    assert [r["gender"] for r in invalid_choices(df, "gender", ["M", "F", "U"]).collect()] == ["X"]
    assert missing_required(df, ["patient_id"]).count() == 1
    assert [tuple(r) for r in duplicate_keys(df, ["patient_id"]).collect()] == [("1", 2)]


def test_insert_delete_documents(spark):
    old = spark.createDataFrame([("1", "a")], "patient_id string, name string")
    new = spark.createDataFrame([("1", "b"), ("2", "c")], "patient_id string, name string")
    assert sorted(tuple(r) for r in insert_if_absent(old, new).collect()) == [("1", "a"), ("2", "c")]
    events = spark.createDataFrame([("1", dt.date(2020, 1, 1)), ("1", dt.date(2020, 2, 1)), ("2", dt.date(2020, 3, 1))],
                                   "patient_id string, event_date date")
    empty_m = spark.createDataFrame([], "patient_id string, result_date date")
    empty_c = spark.createDataFrame([], "patient_id string, admission_date date")
    links = spark.createDataFrame([("2", "Asthma")], "patient_id string, comorb_name string")
    patients = insert_if_absent(old, new)
    docs = {r["patient_id"]: r for r in patient_documents(patients, events, empty_m, empty_c, links).collect()}
    assert docs["1"]["n_events"] == 2 and docs["1"]["last_events"] == dt.date(2020, 2, 1)
    assert docs["2"]["n_comorbidities"] == 1 and docs["1"]["n_measurements"] == 0
    kept = cascade_delete({"patients": patients, "events": events}, spark.createDataFrame([("1",)], "patient_id string"))
    assert [r[0] for r in kept["patients"].collect()] == ["2"]
    assert [r[0] for r in kept["events"].collect()] == ["2"]


def _key(v):
    """The comparison rule: numbers compare as numbers, text trimmed, empty is missing."""
    if v is None or v.strip() == "":
        return None
    try:
        return repr(float(v.strip()))
    except ValueError:
        return v.strip()


def _expected(rows):
    per_file = {}
    for f, i, v in rows:
        k = _key(v)
        if i is not None and k is not None:
            per_file.setdefault((i, f), set()).add(k)
        if i is not None:
            per_file.setdefault((i, f), set())
    out = {}
    for i in {i for (i, _) in per_file}:
        clean = {next(iter(ks)) for (j, _), ks in per_file.items() if j == i and len(ks) == 1}
        n_bad = sum(1 for (j, _), ks in per_file.items() if j == i and len(ks) > 1)
        out[i] = (next(iter(clean)) if len(clean) == 1 else None, n_bad, len(clean) > 1)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv", "c.csv"]), st.sampled_from(["1", "2", "3", None]),
                          st.sampled_from(["34", "34.0", " 34", "35", "M", "m", "", None])),
                min_size=1, max_size=30))
def test_single_value_rule_matches_model(spark, rows):
    from wardline.operators import Single, entity_aggregates
    from wardline.sources import Source, SourceSet

    df = spark.createDataFrame(rows, "_file string, id string, age string")
    files = tuple(sorted({f for f, _, _ in rows}))
    out = entity_aggregates(SourceSet([Source(df.select("id", "age", "_file"), "id", files)], "id"),
                            {"age": Single(("age",))})
    got = {r["id"]: (r["age"], r["age__file_conflicts"], r["age__entity_conflict"]) for r in out.collect()}
    assert got == _expected(rows)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv"]), st.sampled_from(["1", "2", "3"]),
                          st.sampled_from(["neg", "Positive", "suspected", " neg ", "x", "", None])),
                min_size=1, max_size=25))
def test_multi_values_and_tri_state_match_model(spark, rows):
    from pyspark.sql import functions as F

    from wardline.operators import classes, entity_aggregates, multi_values, tri_state
    from wardline.sources import Source, SourceSet

    df = spark.createDataFrame(rows, "_file string, id string, covid string")
    src = SourceSet([Source(df.select("id", "covid", "_file"), "id", ("a.csv", "b.csv"))], "id")
    values = {}
    for _, i, v in rows:
        values.setdefault(i, set())
        if v is not None and v.strip():
            values[i].add(v.strip())
    got = {}
    for r in multi_values(src, ["covid"]).collect():
        got.setdefault(r["id"], set())
        if r["value"] is not None:
            got[r["id"]].add(r["value"])
    assert got == values

    import re

    raw = {}
    for _, i, v in rows:
        raw.setdefault(i, set())
        if v is not None:
            raw[i].add(v)

    def status(vs):   # classes test the raw values: prefix match, any case
        hit = lambda p: any(re.match(p, v, re.IGNORECASE) for v in vs)
        pos, neg, susp = hit("^positive$"), hit("^neg$"), hit("suspected")
        return "P" if pos else ("N" if neg and not susp else "U")

    cl = classes(["covid"], positive=["^positive$"], negative=["^neg$"], suspected=["suspected"])
    out = entity_aggregates(src, {"c": cl}).select(
        "id", tri_state(F.col("c__positive"), F.col("c__negative"), F.col("c__suspected")).alias("s"))
    assert {r["id"]: r["s"] for r in out.collect()} == {i: status(vs) for i, vs in raw.items()}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["outcome_1.csv", "Outcome_2.csv", "demo.csv"]),
                          st.sampled_from(["1", "2", "3"]),
                          st.sampled_from(["Died", "dead on arrival", "home", "alive", None]),
                          st.sampled_from(["Y", "N", " Y", None])),
                min_size=1, max_size=25))
def test_flags_match_model(spark, rows):
    import re

    from wardline.operators import AnyMatch, Presence, ValueEquals, entity_aggregates
    from wardline.sources import Source, SourceSet

    df = spark.createDataFrame(rows, "_file string, id string, destination string, cc string")
    files = tuple(sorted({f for f, *_ in rows}))
    out = entity_aggregates(SourceSet([Source(df.select("id", "destination", "cc", "_file"), "id", files)], "id"),
                            {"died": AnyMatch("outcome", "destination", ("dead", "died", "death")),
                             "cc_value": ValueEquals("outcome", "cc", "Y"), "cc_presence": Presence("outcome")})
    got = {r["id"]: (r["died"], r["cc_value"], r["cc_presence"]) for r in out.collect()}
    exp = {}
    for f, i, dest, cc in rows:
        died, val, pres = exp.get(i, (0, 0, 0))
        if "outcome" in f.lower():
            pres = 1
            died = max(died, int(dest is not None and any(re.match(p, dest, re.I) for p in ("dead", "died", "death"))))
            val = max(val, int(cc is not None and cc.strip() == "Y"))
        exp[i] = (died, val, pres)
    assert got == exp


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2"]),
                          st.sampled_from(["5.5", " 7 ", "abc", "", None]),
                          st.sampled_from(["pos", "neg", "", None]),
                          st.sampled_from(["12 mg dl", "a", "", None])),
                min_size=1, max_size=20))
def test_measurements_match_model(spark, rows):
    from wardline.plans import build_measurements

    df = spark.createDataFrame(rows, "id string, hb string, flag string, cx string")
    m = build_measurements(df, "id", ["hb", "flag", "cx"], ["continuous", "discrete", "complex"], on_invalid="drop")
    got = sorted((r["patient_id"], r["result_name"], r["result_double"], r["result_string"],
                  tuple(r["result_array"]) if r["result_array"] is not None else None) for r in m.collect())
    exp = []
    for i, hb, flag, cx in rows:
        if hb is not None and hb.strip():
            try:
                exp.append((i, "hb", float(hb), None, None))
            except ValueError:
                pass                                   # not a number: dropped under on_invalid="drop"
        if flag is not None and flag.strip():
            exp.append((i, "flag", None, flag, None))
        if cx is not None and cx.strip():
            exp.append((i, "cx", None, None, tuple(cx.split(" "))))
    assert got == sorted(exp)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv", "c.csv"]), st.sampled_from(["1", "2", "3"]),
                          st.sampled_from(["34", "34.0", "35", "x", "", None])),
                min_size=1, max_size=30))
def test_conflict_report_matches_model(spark, rows):
    from wardline.operators import Single, conflict_report
    from wardline.sources import Source, SourceSet

    df = spark.createDataFrame(rows, "_file string, id string, age string")
    files = tuple(sorted({f for f, _, _ in rows}))
    rep = conflict_report(SourceSet([Source(df.select("id", "age", "_file"), "id", files)], "id"),
                          {"age": Single(("age",))})
    got = {tuple(r) for r in rep.collect()}
    groups = {}
    for f, i, v in rows:
        k = _key(v)
        if k is not None:
            groups.setdefault((i, f), set()).add(k)
    exp = set()
    for (i, f), ks in groups.items():
        if len(ks) > 1:
            exp |= {(i, "file", f, "age", k) for k in ks}
    for i in {i for i, _ in groups}:
        clean = {(f, next(iter(ks))) for (j, f), ks in groups.items() if j == i and len(ks) == 1}
        if len({k for _, k in clean}) > 1:
            exp |= {(i, "entity", f, "age", k) for f, k in clean}
    assert got == exp


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv"]), st.sampled_from(["1", "2", "3"]),
                          st.sampled_from(["34", "35.5", "40", None])),
                min_size=1, max_size=20))
def test_correction_matches_model(spark, rows):
    from hypothesis import assume

    from wardline.plans import apply_correction, corrected_values
    from wardline.sources import Source, SourceSet

    ids_with_values = {i for _, i, v in rows if v is not None}
    assume(ids_with_values == {i for _, i, _ in rows})          # every entity has an age somewhere
    df = spark.createDataFrame([(f, i, v, n) for n, (f, i, v) in enumerate(rows)], "_file string, id string, age string, n int")
    files = tuple(sorted({f for f, _, _ in rows}))
    src = SourceSet([Source(df.select("id", "age", "n", "_file"), "id", files)], "id")
    fixed = corrected_values(src, lambda c: F.max(c.cast("double")), ["age"])
    out = apply_correction(src, fixed, ["age"]).sources[0].df
    best = {}
    for _, i, v in rows:
        if v is not None:
            best[i] = max(best.get(i, float("-inf")), float(v))
    got = {r["n"]: float(r["age"]) for r in out.collect()}
    assert got == {n: best[i] for n, (_, i, _) in enumerate(rows)}
