"""Fill-in-the-middle against slices in Python."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wardline.llm.fill_middle import MARKERS, fill_middle, restore


def cut(doc, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in MARKERS) or h3 % 100 >= 90:
        return doc, n, "plain", text, None, None
    x, y, z = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc, n, "spm", f"<S>{z}<P>{x}<M>{y}", a, b - a
    return doc, n, "psm", f"<P>{x}<S>{z}<M>{y}", a, b - a


def test_rows_equal_slices(spark):
    rng = random.Random(3)
    alphabet = "ab \n\r\t\x00́é中😀𝔸<PSM>$\\{}(.*"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    rows += [(1, "the id again"), (1, "the id again"), (None, "no id"), (500, None), (501, ""), (502, "a <S> b"), (503, "<P><M>"),
             (504, "x"), (505, "\n"), (506, "😀" * 150_000 + "é\n" * 50_000), (507, "<" * 9), (508, "$1\\2" * 20), (509, "S><S<P><"[:3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("form", F.lit(1)).withColumn("h1", F.lit(2))
    out = fill_middle(docs)
    assert out.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted((cut(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = out.select("doc_id", restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_other_markers_shares_and_empty_table(spark):
    rows = [(i, f"text {i} $0 \\1 with a.b*c (d) [e]") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = ("\u0001pre|", "\u0002suf$1", "\u0003mid\\")
    out = fill_middle(docs, plain_percent=0, spm_percent=100, seed=9, markers=marks)
    got = out.withColumn("back", restore(F.col("output"), F.col("form"), marks)).collect()
    assert all(r["form"] == "spm" and r["output"].startswith(marks[1]) and r["back"] == rows[r["doc_id"]][1] for r in got)
    assert {r["form"] for r in fill_middle(docs, plain_percent=100).collect()} == {"plain"}
    assert fill_middle(docs.limit(0)).count() == 0
    for bad in (("", "b", "c"), ("<P>", "<P>", "<M>"), ("<P", "<P>", "<M>"), ("<a<", "<b>", "<c>")):
        with pytest.raises(ValueError):
            fill_middle(docs, markers=bad)
