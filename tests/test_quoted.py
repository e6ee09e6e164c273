"""Large quoted CSV files put together from their lines, against the multi-line reader."""
import random
from contextlib import contextmanager

import pytest

from wardline.sources.files import discover, joinable, load_directory, read_csv_group, split_safe
from wardline.sources.quoted import parity_safe, records

HEADER = ["id", "a", "b"]


@contextmanager
def split_bytes(spark, n):
    name = "spark.sql.files.maxPartitionBytes"
    before, cost = spark.conf.get(name), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(name, str(n))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def field(rng, end):
    kind = rng.randrange(5)
    text = "".join(rng.choice("xyé, ") for _ in range(rng.randrange(8))).replace(",", "")
    if kind < 2:
        return text
    inner = "".join(rng.choice(["x", ",", '""', end, "é", " ", end * 2]) for _ in range(rng.randrange(12)))
    return f'"{inner * (30 if kind == 4 and rng.random() < 0.1 else 1)}"'


def csv_text(rng, n, end, header="id,a,b"):
    rows = [header]
    for i in range(n):
        rows.append(",".join([str(i), field(rng, end), field(rng, end)]))
        if rng.random() < 0.1:
            rows.append(rng.choice(["", "  "]))
    return end.join(rows) + (end if rng.random() < 0.5 else "")


def rows_of(source):
    return sorted(map(repr, source.df.select("id", "a", "b", "_file").collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multiline_reader(spark, tmp_path, end):
    rng = random.Random(len(end))
    for k in range(3):
        (tmp_path / f"f {k}+%.csv").write_bytes(csv_text(rng, 120, end).encode())
    files = discover(spark, str(tmp_path))
    want = rows_of(read_csv_group(spark, files, HEADER, "id", True))
    assert len(want) >= 360
    for size in (197,):
        with split_bytes(spark, size):
            assert joinable(spark, files) == {f.name for f in files}
            got = read_csv_group(spark, files, HEADER, "id")
            assert rows_of(got) == want, size


def test_split_into_many_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_text(csv_text(random.Random(3), 400, "\n"))
    with split_bytes(spark, 1000):
        path = str(tmp_path / "one.csv")
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 5
        assert records(spark, [path]).where("header").count() == 1


def test_quote_inside_a_plain_field_is_left_to_the_multiline_reader(spark, tmp_path):
    (tmp_path / "inches.csv").write_text("id,a,b\n" + "".join(f'{i},{i}" pipe,"x\ny"\n' for i in range(50)))
    (tmp_path / "good.csv").write_text("id,a,b\n" + "".join(f'{i},"{i}"" pipe","x\ny"\n' for i in range(50)))
    (tmp_path / "open.csv").write_text("id,a,b\n" + "".join(f'{i},"p\nq",r\n' for i in range(50)) + '99,"never\nclosed')
    (tmp_path / "ends.csv").write_bytes(b"id,a,b\n" + b"".join(b'%d,"x\r\ny",z\r\n' % i for i in range(50)))
    with split_bytes(spark, 64):
        files = discover(spark, str(tmp_path))
        assert joinable(spark, files) == {"good.csv"}
        out = {f.name: {r["id"]: r["a"] for r in read_csv_group(spark, [f], HEADER, "id").df.collect()} for f in files[1:3]}
    assert out["good.csv"]["7"] == out["inches.csv"]["7"] == '7" pipe'


def test_header_with_a_line_break_blank_start_and_empty_file(spark, tmp_path):
    (tmp_path / "h.csv").write_text('\n  \n"id","a\nb"\n' + "".join(f'{i},"p\nq"\n' for i in range(30)))
    (tmp_path / "none.txt").write_text("")
    with split_bytes(spark, 40):
        path = str(tmp_path / "h.csv")
        got = records(spark, [path]).collect()
        assert [r["record"] for r in got if r["header"]] == ['"id","a\nb"']
        assert sorted(r["record"] for r in got if not r["header"] and r["record"].strip()) == sorted(f'{i},"p\nq"' for i in range(30))
        assert records(spark, [str(tmp_path / "none.txt")]).count() == 0
        assert parity_safe(spark, [str(tmp_path / "none.txt")]) == set()


def test_load_directory_reads_large_quoted_files(spark, tmp_path):
    (tmp_path / "big.csv").write_text("id,a,b\n" + "".join(f'{i},"l1\nl2, {i}",z\n' for i in range(200)))
    (tmp_path / "flat.csv").write_text("id,a,b\n900,x,y\n")
    with split_bytes(spark, 300):
        rows = {r["id"]: (r["a"], r["_file"]) for r in load_directory(spark, str(tmp_path), "id").sources[0].df.collect()}
    assert len(rows) == 201 and rows["7"] == ("l1\nl2, 7", "big.csv") and rows["900"] == ("x", "flat.csv")


def test_records_are_put_together_once(spark, tmp_path):
    """the check of the records and their rows share one pass over a file's lines."""
    (tmp_path / "big.csv").write_text("id,a,b\n" + "".join(f'{i},"l1\nl2, {i}",z\n' for i in range(200)))
    with split_bytes(spark, 300):
        rows = read_csv_group(spark, discover(spark, str(tmp_path)), HEADER, "id").df
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" not in plan and rows.count() == 200


def test_carriage_returns_in_quoted_files(spark, tmp_path):
    (tmp_path / "plain+.csv").write_bytes(b'id,a,b\r1,x,y\r2,"x",y\r')
    (tmp_path / "ends.csv").write_bytes(b'id,a,b\r\n1,"x\r\ny",z\r\n')
    files = discover(spark, str(tmp_path))
    assert split_safe(spark, files) == {"plain+.csv"}
    (tmp_path / "lone.csv").write_bytes(b'id,a,b\n1,"x\ry",z\n')
    with pytest.raises(ValueError, match="Carriage returns.*: lone.csv"):
        split_safe(spark, discover(spark, str(tmp_path)))
