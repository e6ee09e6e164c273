"""S1-S3, S7, P6, U1 on hand-made CSV and XLSX fixtures."""
import os

import pytest
from pyspark.sql import functions as F

from wardline.sources import SourceSet, discover, load_directory, union_sources
from wardline.sources.excel import read_sheet
from xlsx import write_xlsx


def _write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


def test_discover_filters_extensions(spark, workdir):
    for name in ["a.csv", "b.CSV", "c.xlsx", "d.XLSX", "e.txt", "g [1].csv"]:
        _write(os.path.join(workdir, name), "id\n1\n")
    os.makedirs(os.path.join(workdir, "k=v"))
    _write(os.path.join(workdir, "k=v", "inner.csv"), "id\n1\n")
    names = [f.name for f in discover(spark, workdir)]
    assert names == ["a.csv", "b.CSV", "c.xlsx", "d.XLSX", "g [1].csv"]
    assert load_directory_of(spark, workdir, ["a.csv", "g [1].csv"]) == [("1", "a.csv"), ("1", "g [1].csv")]
    for bad in ["_wards.csv", ".wards.csv", "f.xls"]:
        _write(os.path.join(workdir, bad), "id\n1\n")
        with pytest.raises(ValueError, match=bad):
            discover(spark, workdir)
        os.rename(os.path.join(workdir, bad), os.path.join(workdir, bad + ".txt"))


def load_directory_of(spark, workdir, names):
    from wardline.sources.files import read_csv_group, read_csv_headers

    files = [f for f in discover(spark, workdir) if f.name in names]
    assert read_csv_headers(spark, files) == {n: ["id"] for n in names}
    return sorted((r["id"], r["_file"]) for r in read_csv_group(spark, files, ["id"], "id").df.collect())


AWKWARD = 'id,_flag,note\r\n1,NA,"say ""hi"""\r\n   \r\n\r\n2\r\n3,x,plain\r\n ,y,z\r\n'


def test_same_rows_from_both_readers(spark, workdir):
    """Blank lines, short rows, null tokens and a `_` column read alike, line by line and multi-line."""
    from wardline.sources.files import read_csv_group

    _write(os.path.join(workdir, "a.csv"), AWKWARD)
    files = discover(spark, workdir)
    for multiline in (True, False, "auto"):
        df = read_csv_group(spark, files, ["id", "_flag", "note"], "id", multiline).df
        rows = sorted((r["id"] or "", r["_flag"], r["note"]) for r in df.collect())
        assert rows == [("", "y", "z"), ("1", None, 'say "hi"'), ("2", None, None), ("3", "x", "plain")], multiline
    _write(os.path.join(workdir, "b.csv"), 'id,note\n1,3\r0\n2,x\n')
    lines = read_csv_group(spark, [f for f in discover(spark, workdir) if f.name == "b.csv"], ["id", "note"], "id").df
    assert sorted(r["id"] for r in lines.collect()) == ["0", "1", "2"]        # a lone carriage return ends a line
    _write(os.path.join(workdir, "c.csv"), 'id,note\n1,"a\nb"\n2,3\r0\n')
    with pytest.raises(ValueError, match="c.csv"):
        read_csv_group(spark, [f for f in discover(spark, workdir) if f.name == "c.csv"], ["id", "note"], "id")


def test_csv_scan_rows(spark, workdir):
    _write(os.path.join(workdir, "demographics.csv"),
           'id,age,note\n007,34,"two\nlines"\n1,NA,x\n2,,null\n3,35\n')
    srcs = load_directory(spark, workdir, "id")
    assert len(srcs) == 1
    rows = {r["id"]: r.asDict() for r in srcs.sources[0].df.collect()}
    assert set(rows) == {"007", "1", "2", "3"}
    assert rows["007"]["note"] == "two\nlines"          # quoted newline: one record
    assert rows["1"]["age"] is None and rows["2"]["note"] is None   # null tokens
    assert rows["3"]["note"] is None                     # short row filled with null
    assert rows["007"]["_file"] == "demographics.csv"


def test_csv_long_row_fails_naming_file(spark, workdir):
    _write(os.path.join(workdir, "bad.csv"), "id,a,b\n1,x,y\n1,x,y,EXTRA\n")
    srcs = load_directory(spark, workdir, "id")
    with pytest.raises(Exception, match="bad.csv"):
        srcs.sources[0].df.collect()


def test_missing_id_column(spark, workdir):
    _write(os.path.join(workdir, "a.csv"), "id,x\n1,2\n")
    _write(os.path.join(workdir, "b.csv"), "pid,x\n1,2\n")
    with pytest.raises(AssertionError, match="b.csv"):
        load_directory(spark, workdir, "id")


def test_union_by_keyword_aligns_by_name(spark, workdir):
    _write(os.path.join(workdir, "outcome_1.csv"), "id,a\n1,x\n")
    _write(os.path.join(workdir, "Outcome_2.csv"), "id,b\n2,y\n")
    _write(os.path.join(workdir, "other.csv"), "id,c\n3,z\n")
    srcs = load_directory(spark, workdir, "id")
    assert len(srcs) == 3            # three headers, three reads
    out = union_sources(srcs.select_keyword("OUTCOME"), keyword="outcome")
    rows = sorted((r["id"], r["a"], r["b"]) for r in out.collect())
    assert rows == [("1", "x", None), ("2", None, "y")]
    with pytest.raises(ValueError, match="nothing"):
        union_sources(srcs.select_keyword("nothing"), keyword="nothing")


def test_same_header_files_share_one_read(spark, workdir):
    _write(os.path.join(workdir, "p1.csv"), "id,age\n1,30\n")
    _write(os.path.join(workdir, "p2.csv"), "id,age\n2,40\n")
    srcs = load_directory(spark, workdir, "id")
    assert len(srcs) == 1 and srcs.sources[0].files == ("p1.csv", "p2.csv")
    assert sorted((r["id"], r["_file"]) for r in srcs.sources[0].df.collect()) == [("1", "p1.csv"), ("2", "p2.csv")]


def test_xlsx_roundtrip(spark, workdir):
    path = os.path.join(workdir, "outcome_2.xlsx")
    write_xlsx(path, ["id", "event_type", "destination"], [[7, "admission", "home"], [8, "death", None]])
    with open(path, "rb") as f:
        assert read_sheet(f.read()) == [["id", "event_type", "destination"], ["7", "admission", "home"],
                                        ["8", "death"]]
    _write(os.path.join(workdir, "outcome_1.csv"), "id,event_type,destination\n1,discharge,home\n")
    srcs = load_directory(spark, workdir, "id")
    out = union_sources(srcs.select_keyword("outcome"))
    rows = sorted((r["id"], r["event_type"], r["destination"], r["_file"]) for r in out.collect())
    assert rows == [("1", "discharge", "home", "outcome_1.csv"), ("7", "admission", "home", "outcome_2.xlsx"),
                    ("8", "death", None, "outcome_2.xlsx")]


def test_split_probe_and_doubled_quotes(spark, workdir):
    import wardline.sources.files as files_mod

    _write(os.path.join(workdir, "flat.csv"), 'id,note\n1,"say ""hi"""\n2,plain\n')
    _write(os.path.join(workdir, "broken.csv"), 'id,note\n3,"two\nlines"\n')
    found = discover(spark, workdir)
    assert all(f.size > 0 for f in found)
    assert files_mod.split_safe(spark, found) == {"flat.csv"}
    out = union_sources(load_directory(spark, workdir, "id"))
    rows = {r["id"]: r["note"] for r in out.collect()}
    assert rows == {"1": 'say "hi"', "2": "plain", "3": "two\nlines"}


def test_xlsx_many_batches(spark, workdir):
    import wardline.sources.excel as excel_mod

    n = 2 * excel_mod.BATCH_ROWS + 5000
    write_xlsx(os.path.join(workdir, "big.xlsx"), ["id", "value"], [[i, f"v{i}"] for i in range(n)])
    out = union_sources(load_directory(spark, workdir, "id"))
    assert out.count() == n
    assert out.where("id = '24999' and value = 'v24999'").count() == 1
    assert out.select("id").distinct().count() == n


def test_empty_workbook_is_reported(spark, workdir):
    write_xlsx(os.path.join(workdir, "empty.xlsx"), [], [])
    _write(os.path.join(workdir, "a.csv"), "id,x\n1,2\n")
    with pytest.raises(AssertionError, match="empty.xlsx"):
        load_directory(spark, workdir, "id")


def test_dotted_and_duplicate_headers(spark, workdir):
    from wardline.operators import Single, entity_aggregates, melt_onehot
    from wardline.plans import build_measurements

    _write(os.path.join(workdir, "demo.csv"), "id,age.years,x,x\n1,34,a,b\n2,40,c,d\n")
    srcs = load_directory(spark, workdir, "id")
    assert srcs.sources[0].columns == ["age.years", "x2", "x3"]          # Spark suffixes duplicate names with their position
    out = {r["id"]: r["age"] for r in entity_aggregates(srcs, {"age": Single(("(?:.*[._-])?age(?:[._-].*)?$",))}).collect()}
    assert out == {"1": "34.0", "2": "40.0"}
    df = srcs.sources[0].df
    m = build_measurements(df, "id", ["age.years"], ["continuous"]).collect()
    assert sorted((r["patient_id"], r["result_name"], r["result_double"]) for r in m) == [
        ("1", "age.years", 34.0), ("2", "age.years", 40.0)]
    flags = spark.createDataFrame([("1", 1, 0)], "id string, `has.flag` int, other int")
    assert [tuple(r) for r in melt_onehot(flags, "id").collect()] == [("1", "has.flag")]


def test_xlsx_duplicate_headers(spark, workdir):
    write_xlsx(os.path.join(workdir, "dup.xlsx"), ["id", "x", "x"], [[1, "a", "b"]])
    srcs = load_directory(spark, workdir, "id")
    assert srcs.sources[0].columns == ["x1", "x2"]
    assert [(r["x1"], r["x2"]) for r in srcs.sources[0].df.collect()] == [("a", "b")]


def test_headers_are_partial_reads_without_a_job(spark, workdir):
    from wardline.sources.files import discover, read_csv_headers

    bodies = {"a.csv": "pid,x\n" + "1,2\n" * 50_000, "b.csv": "﻿pid,x\r\n1,2\r\n", "c.csv": "\n \n pid ,\"y, z\"\n1,2\n", "d.csv": "pid,x", "e.csv": "pid,\"two\nlines\"\n1,2\n",
              "f é.csv": "pid,x\r1,2\r"}
    for name, body in bodies.items():
        with open(os.path.join(workdir, name), "w", newline="", encoding="utf-8") as f:
            f.write(body)
    files = discover(spark, workdir)
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        plain = [f for f in files if f.name not in ("c.csv", "e.csv")]
        headers = read_csv_headers(spark, plain)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert all(h == ["pid", "x"] for h in headers.values()) and len(headers) == 4
    assert jobs <= 2                      # Spark parses the one distinct line; it reads no file
    assert read_csv_headers(spark, files)["e.csv"] == ["pid", "two\nlines"]
    assert read_csv_headers(spark, files)["c.csv"] == [" pid ", "y, z"]
