"""Helpers shared by the operators: shared tables, words, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# White space of the data contracts: space, and the ASCII controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only where the setting and the context's folder are both unset, and the
    master is local (tests), an own temporary folder is set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="wardline-llm-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/wardline_llm/{uuid.uuid4().hex}-{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage,
    and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` made and that is no longer read."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles() if "/wardline_llm/" in f}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


PLAIN_EDGES = 20_000  # edges of a step from which its sums are written before they are joined


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of ``links(a, b)`` as ``(node, component)``, component
    being the smallest node reachable.

    Alternates large-star and small-star steps: every node hands its neighbours
    to the smallest of them, so that each step sends a node's edges to one
    neighbour only, and a group of n copies needs about log n steps.  Each step
    is written to the shared folder; the fixed point is found by comparing an
    order-free digest of the edges, observed while they are written.  A step's
    smallest neighbours are written, too, where there are more than
    ``PLAIN_EDGES`` edges: joined as a table, adaptive execution splits the
    edges of a hub over tasks, which it does not beside an aggregate.  Self
    links and repeated links are ignored, nulls must not occur; no links give
    no rows.
    """
    def written(edges: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        edges = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        return materialise(edges, "edges"), seen.get

    edges, digest = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(rounds):
        aside = (lambda df: materialise(df, "least")) if digest["n"] > PLAIN_EDGES else (lambda df: df)
        # Large star: neighbours above u go to the smallest neighbour of u.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = aside(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = aside(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: u and its neighbours below go to the smallest of them.
        low = aside(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        steps = [least, large, low] if digest["n"] > PLAIN_EDGES else []
        after, digest = written(small)
        for used in (edges, *steps):
            drop_table(used)
        edges = after
        if digest == before:
            break
        before = digest
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
