"""The reference's seven literal cases plus extra layouts."""
from wardline.functions import join_datetime, render_date, with_parsed_datetime

# (text, rendered date, minutes) -- the first seven rows are the reference's test cases.
CASES = [
    ("15/03/2020", "15/3/2020", None),
    ("1/30/2020", None, None),
    ("15/3/2020 15:00:00", "15/3/2020", 900.0),
    ("15/3/2020 15:35", "15/3/2020", 935.0),
    ("12/01/2020 00:00:00", "12/1/2020", 0.0),
    ("12/01/2020 2pm", "12/1/2020", 840.0),
    ("12/01/2020 2:30pm", "12/1/2020", 870.0),
    ("15/3/20 15:35", "15/3/2020", 935.0),
    ("15.3.2020", "15/3/2020", None),
    ("15-3-2020 09:05", "15/3/2020", 545.0),
    ("2020-03-15", "15/3/2020", None),
    ("2020-03-15T10:05:00", "15/3/2020", 605.0),
    ("2020-03-15T10:05:00Z", "15/3/2020", 605.0),
    ("2020-03-15T10:05:00.25+01:00", "15/3/2020", 605.0),
    ("15/03/2020 10:30:05,5", "15/3/2020", 630.0),
    ("15/03/2020 10:30:75,5", None, None),
    ("15 March 2020", "15/3/2020", None),
    ("15-Mar-2020 9:15am", "15/3/2020", 555.0),
    ("15/3/2020 12am", "15/3/2020", 0.0),
    ("15/3/2020 12pm", "15/3/2020", 720.0),
    ("  15/3/2020 13:00  ", "15/3/2020", 780.0),
    ("30/02/2020", None, None),
    ("15/3/2020 25:00", None, None),
    ("15/3/2020 nonsense", None, None),
    ("garbage", None, None),
    (None, None, None),
]


def test_parse_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "i int, t string")
    out = with_parsed_datetime(df, "t", "d", "m")
    got = {r["i"]: (r["r"], r["m"]) for r in out.select("i", render_date("d").alias("r"), "m").collect()}
    for i, (text, date, minutes) in enumerate(CASES):
        assert got[i] == (date, minutes), text


def test_join_datetime(spark):
    df = spark.createDataFrame([("15/3/2020", "10:30"), ("15/3/2020", None), (None, "10:30")], "d string, t string")
    dotted = df.withColumnsRenamed({"d": "adm.date", "t": "adm.time"})
    assert dotted.select(join_datetime(["adm.date", "adm.time"])).count() == 3
    got = [r[0] for r in df.select(join_datetime(["d", "t"])).collect()]
    assert got == ["15/3/2020 10:30", "15/3/2020", None]
