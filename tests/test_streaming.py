"""§7.6: availableNow file-drop ingestion reuses the batch builders."""
import os

from wardline.plans import build_events
from wardline.streaming import csv_stream, ingest


def test_filedrop_events(spark, workdir):
    drop = os.path.join(workdir, "drop")
    os.makedirs(drop)
    header = ["pid", "event_type", "when"]
    with open(os.path.join(drop, "outcome_1.csv"), "w") as f:
        f.write("pid,event_type,when\n1,admission,15/3/2020 10:00\n2,death,16/3/2020\n")
    sink, ckpt = os.path.join(workdir, "events"), os.path.join(workdir, "ckpt")

    def run():
        q = ingest(csv_stream(spark, drop, header, "pid"),
                   lambda b: build_events(b, "pid", "when", {"event_type": "event_type"}), sink, ckpt)
        q.awaitTermination(120)

    run()
    assert spark.read.parquet(sink).count() == 2
    with open(os.path.join(drop, "outcome_2.csv"), "w") as f:
        f.write("pid,event_type,when\n3,discharge,17/3/2020 08:15\n")
    run()                                   # only the new file is loaded
    rows = sorted((r["patient_id"], r["event_type"], r["event_time"]) for r in spark.read.parquet(sink).collect())
    assert rows == [("1", "admission", 600.0), ("2", "death", None), ("3", "discharge", 495.0)]


def test_stream_cleans_as_the_batch_scan_does(spark, workdir):
    import pytest

    drop = os.path.join(workdir, "drop")
    os.makedirs(drop)
    with open(os.path.join(drop, "a.csv"), "w", newline="") as f:
        f.write('pid,_flag,note\n1,NA,"two\nlines"\n   \n2\n')
    sink = os.path.join(workdir, "sink")

    def run(ckpt):
        stream = csv_stream(spark, drop, ["pid", "_flag", "note"], "pid")
        ingest(stream, lambda b: b, sink, os.path.join(workdir, ckpt)).awaitTermination(120)

    run("c1")
    run("c2")                                # the same batch again, as after a lost commit: replaced, not added
    rows = sorted((r["pid"], r["_flag"], r["note"]) for r in spark.read.parquet(sink).collect())
    assert rows == [("1", None, "two\nlines"), ("2", None, None)]
    for name, text in (("b.csv", "note,_flag,pid\nx,y,3\n"), ("c.csv", "pid,_flag,note\n1,2,3,4\n")):
        with open(os.path.join(drop, name), "w") as f:
            f.write(text)
        with pytest.raises(Exception):
            run("c1")
        os.rename(os.path.join(drop, name), os.path.join(drop, name + ".txt"))
