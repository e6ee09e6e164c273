"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2c) apart, so the cosine threshold is a
distance.  Vectors are rotated to their principal dimensions, put in the
lexicographic order of grid cells of that distance on the leading ones, and the
sequence is cut into intervals.  Two intervals of one label meet only if their
bounding boxes are near enough; inside a task the pair is split recursively and
provably distant halves are skipped, until blocks are compared by a matrix
product in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import components, materialise

LEADING = 8  # principal dimensions of the grid
INTERVAL = 1 << 19  # numbers of an interval
BLOCK = 512  # vectors compared by one matrix product


def _units(column: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)
    scale = np.abs(x).max(axis=1, keepdims=True)  # the squares of very large or small numbers stay finite
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and dimension, the sum of products of differences between neighbours of one label."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        dims, labels = np.asarray(batch.column("dim")), np.asarray(batch.column("label"))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            at = at[np.argsort(labels[at], kind="stable")]
            x, label = _units(batch.column("embedding").take(pa.array(at)), int(dim)), labels[at]
            step = np.diff(x, axis=0)[label[1:] == label[:-1]]
            total[int(dim)] = total.get(int(dim), 0) + step.T @ step
    yield pa.RecordBatch.from_pydict({"dim": pa.array(list(total), pa.int32()),
                                      "sums": pa.array([t.ravel().tolist() for t in total.values()], pa.list_(pa.float64()))})


def principal_dimensions(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the leading principal directions within labels, as columns; over all rows."""
    sums = (vectors.mapInArrow(_scatter, "dim int, sums array<double>")
            .select("dim", F.posexplode("sums")).groupBy("dim", "pos").agg(F.sum("col").alias("s")))
    found: dict[int, np.ndarray] = {}
    for r in sums.collect():  # a square matrix per vector length
        found.setdefault(r.dim, np.zeros((r.dim, r.dim)))[divmod(r.pos, r.dim)] = r.s
    return {d: np.linalg.eigh(m)[1][:, ::-1][:, :LEADING] for d, m in found.items()}


def _project(axes: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            place = np.zeros((len(dims), LEADING))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                q = axes[int(dim)]
                place[at, :q.shape[1]] = _units(batch.column("embedding").take(pa.array(at)), int(dim)) @ q
            cols = [*batch.columns, pa.array(place.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "place"])

    return run


def _intervals(number: str) -> tuple[str, pa.Schema]:
    """The schema of intervals whose vectors hold numbers of type ``number``, float or double."""
    schema = pa.schema([("iv", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("ids", pa.list_(pa.int64())),
                        ("copies", pa.list_(pa.int64())), ("vectors", pa.list_(pa.float32() if number == "float" else pa.float64())),
                        ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))])
    return f"iv long, label long, dim int, ids array<long>, copies array<long>, vectors array<{number}>, lo array<double>, hi array<double>", schema


def _cut(schema: pa.Schema):
    """Cut the sorted sequence of a task into intervals of one label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, key = TaskContext.get().partitionId() << 32, [], None

        def flush():
            ids, copies, vectors, places = zip(*held)
            place = np.array(places)
            row = [made, key[0], key[1], list(ids), list(copies), np.concatenate(vectors), place.min(axis=0).tolist(), place.max(axis=0).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, schema)], schema=schema)

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("label", "dim", "rep", "copies")]
            for i, (label, dim, rep, copies) in enumerate(zip(*cols)):
                if held and (key != (label, dim) or len(held) >= max(BLOCK, INTERVAL // dim)):
                    yield flush()
                    made, held = made + 1, []
                key = (label, dim)
                held.append((rep, copies, np.asarray(batch.column("embedding")[i].values), batch.column("place")[i].as_py()))
        if held:
            yield flush()

    return run


def _compare(cosine: float, axes: dict[int, np.ndarray]):
    """Of each pair of intervals, per vector its number of links in the pair and the smallest id it is connected to."""
    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9

    def near(a: np.ndarray, b: np.ndarray) -> bool:
        gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
        return float(gap @ gap) <= reach * reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                dim, alone = row["dim"].as_py(), row["iv_a"].as_py() == row["iv_b"].as_py()
                sides = []
                for s in ("a",) if alone else ("a", "b"):
                    x = _units(pa.ListArray.from_arrays([0, len(row[f"vectors_{s}"].values)], row[f"vectors_{s}"].values), dim)
                    sides.append((np.asarray(row[f"ids_{s}"].values), np.asarray(row[f"copies_{s}"].values), x, x @ axes[dim]))
                ids = np.concatenate([s[0] for s in sides])
                copies = np.concatenate([s[1] for s in sides])
                x = np.concatenate([s[2] for s in sides])
                place = np.concatenate([s[3] for s in sides])
                n = len(sides[0][0])
                links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

                def connect(i: int, others: np.ndarray) -> None:
                    roots = np.unique(np.append(root[others], root[i]))
                    if len(roots) > 1:
                        root[np.isin(root, roots)] = roots[np.argmin(ids[roots])]

                def join(a0: int, a1: int, b0: int, b1: int) -> None:
                    if not near(place[a0:a1], place[b0:b1]):
                        return
                    if max(a1 - a0, b1 - b0) > BLOCK:  # split the longer side; a part with itself gives three pairs
                        if (a0, a1) == (b0, b1):
                            m = (a0 + a1) // 2
                            join(a0, m, a0, m), join(m, a1, m, a1), join(a0, m, m, a1)
                        elif a1 - a0 >= b1 - b0:
                            m = (a0 + a1) // 2
                            join(a0, m, b0, b1), join(m, a1, b0, b1)
                        else:
                            m = (b0 + b1) // 2
                            join(a0, a1, b0, m), join(a0, a1, m, b1)
                        return
                    hit = x[a0:a1] @ x[b0:b1].T >= cosine
                    if (a0, a1) == (b0, b1):
                        np.fill_diagonal(hit, False)
                        links[a0:a1] += hit @ copies[b0:b1]
                    else:
                        links[a0:a1] += hit @ copies[b0:b1]
                        links[b0:b1] += copies[a0:a1] @ hit
                    for r in np.flatnonzero(hit.any(axis=1)):
                        connect(a0 + r, b0 + np.flatnonzero(hit[r]))

                if alone:
                    join(0, n, 0, n)
                else:
                    join(0, n, n, len(ids))
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at]), pa.array(ids[root[at]])], names=["id", "links", "root"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Rows of one label (null labels: none) link when the cosine of their vectors,
    in double precision, is ``cosine`` (above 0) or more; vectors of different
    lengths, null, empty or zero vectors and such with null or non-finite
    components link with nothing.  n_links counts the other rows linked
    directly, component_id is the smallest id reachable, kept marks the rows
    whose id that is.  Equal vectors of a label are compared once and counted as
    often as they occur; rows that repeat an id are rows of their own, each
    with the links of its own vector.  A null id has a null component, and is
    not kept.  An empty table gives no rows.  Components keep their type, float
    or double; labels may be of any type, those that are no whole numbers are
    compared by a 64-bit hash.  Ids are whole numbers.
    """
    double = isinstance(vectors.schema[vector_col].dataType.elementType, (T.DoubleType, T.DecimalType, T.IntegralType))
    number = "double" if double else "float"
    label = F.col(label_col).cast("long") if isinstance(vectors.schema[label_col].dataType, T.IntegralType) else F.xxhash64(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.col(label_col).isNotNull(), label).alias("label"),
                          F.col(vector_col).cast(f"array<{number}>").alias("embedding"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound
                        & F.exists("embedding", lambda v: v != 0), F.lit(False))
    distinct = (rows.where(usable).groupBy("label", "embedding")
                .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("dim", F.size("embedding")))
    # A number for each vector of a label: ids may repeat over them.
    distinct = materialise(distinct.withColumn("rep", F.monotonically_increasing_id()), "grid-vectors")
    axes = principal_dimensions(distinct)
    width = math.sqrt(2 - 2 * cosine)
    placed = distinct.mapInArrow(_project(axes), f"label long, embedding array<{number}>, first long, copies long, dim int, rep long, place array<double>")
    cells = [F.floor(F.col("place")[i] / width) for i in range(LEADING)]
    order = [F.col("label"), F.col("dim"), *cells, F.col("rep")]
    schema, arrow_schema = _intervals(number)
    intervals = materialise(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut(arrow_schema), schema), "grid-intervals")

    # Pairs of intervals: they share a cell of the first dimension or have neighbouring ones, and their boxes are near.
    first = lambda side: F.floor(F.col(side)[0] / width)
    narrow = intervals.select("iv", "label", "dim", "lo", "hi")
    left = narrow.select(F.col("iv").alias("iv_a"), "label", "dim", F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"),
                         F.explode(F.sequence(first("lo"), first("hi"))).alias("cell"))
    right = narrow.select(F.col("iv").alias("iv_b"), "label", "dim", F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"),
                          F.explode(F.sequence(first("lo") - 1, first("hi") + 1)).alias("cell"))
    gaps = [F.greatest(F.lit(0.0), F.col("lo_a")[i] - F.col("hi_b")[i], F.col("lo_b")[i] - F.col("hi_a")[i]) for i in range(LEADING)]
    near = sum((g * g for g in gaps), F.lit(0.0)) <= width * width + 1e-9
    pairs = left.join(right, ["label", "dim", "cell"]).where((F.col("iv_a") <= F.col("iv_b")) & near).select("iv_a", "iv_b").distinct()
    full = pairs
    for s in ("a", "b"):
        full = full.join(intervals.select(F.col("iv").alias(f"iv_{s}"), *([F.col("dim")] if s == "a" else []),
                                          *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vectors")]), f"iv_{s}")
    found = materialise(full.mapInArrow(_compare(cosine, axes), "id long, links long, root long"), "grid-links")

    comp = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    members = materialise(distinct.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("class", F.coalesce("component", "rep")), "grid-members")
    least = materialise(members.groupBy("class").agg(F.min("first").alias("component_id")), "grid-least")
    counts = materialise(found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links")), "grid-counts")
    per = (members.join(counts, "rep", "left").join(least, "class")
           .select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id"))
    rows = rows.withColumn("usable", usable)
    own = rows.join(per, F.col("usable") & (rows["label"] == per["l"]) & (rows["embedding"] == per["e"]), "left")
    out = own.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
