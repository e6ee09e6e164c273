"""Connected components of a graph given as edges.

Each round has a local and a global part.  Locally, every task joins the nodes
of its own edges by union-find and hands on one edge per node, to the smallest
node it found; so a graph that fits one partition is done after one round.
Globally, every node passes its neighbours on to the smallest of them (the
large-star and small-star steps of Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014).  Rounds are checkpointed; they end when the edges
stay the same, which an order-free digest tells, observed while they are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wardline.session import checkpoint_dir


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of one task as stars: (node, smallest node that its edges connect it to)."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch["u"], batch["v"]):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(x, root(x)) for x in list(parent)]
    stars = [(x, r) for x, r in stars if x != r]
    yield pd.DataFrame(stars, columns=["u", "v"])


def connected_components(edges: DataFrame, a: str, b: str, rounds: int = 100) -> DataFrame:
    """``node, component`` of the nodes of ``edges``, component being the smallest node that can be reached.

    Self links and repeated edges are ignored; nulls must not occur; no edges
    give no rows.
    """
    checkpoint_dir(edges.sparkSession)
    kind = edges.schema[a].dataType.simpleString()

    def written(df: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        digest = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")]
        return df.observe(seen, *digest).checkpoint(), seen.get

    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    before = None
    for _ in range(rounds):
        links = links.mapInPandas(_contract, f"u {kind}, v {kind}")
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        links, digest = written(large.join(low, "u").select(pair).select("e.u", "e.v").where("u <> v").distinct())
        if digest == before:
            break
        before = digest
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
