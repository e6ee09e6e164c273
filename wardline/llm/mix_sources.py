"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.llm.common import WORD, materialise

BINS = 4096  # key bins of a source at each of two levels


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def surface_quality(text: Column) -> Column:
    """Sampling weight of a text, 0.05 to 1: one less five times its marks ``!#$%&*|`` per word."""
    marks = F.coalesce(F.regexp_count(text, F.lit(r"[!#$%&*|]")), F.lit(0))
    return F.greatest(F.lit(0.05), 1 - 5.0 * marks / F.greatest(F.lit(1), word_count(text)))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on ``key`` and ``seed`` alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size, target`` of ``sizes(source, size)``.

    Sources in code point order, null last, take ``weights`` in turn and share
    ``share`` times all sizes.  No target passes ``cap`` times its source's
    size; what is cut goes to the others by weight until none is above, which
    is a common level: target = least(cap * size, level * weight).  The windows
    run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.select("source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                           (n % len(weights) + 1).cast("int")).alias("weight"))
    src = src.withColumn("most", cap * F.col("source_size"))
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy()) * share
    src = src.withColumn("level", (total - full) / open_weight)
    fits = F.col("level") * F.col("weight") <= F.col("most")
    level = F.min(F.when(fits, F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))).over(W.partitionBy())
    return src.select("source", "source_size",
                      F.coalesce(F.least(F.col("most"), level["level"] * F.col("weight")), F.col("most")).alias("target"))


def mix(docs: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, cap: float = 2.0, seed: int = 17,
        quality: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``.

    A source whose target holds its size k times gives k whole epochs; the rest
    of the target is filled by weighted sampling without replacement: each row
    draws the key -ln(u) / quality, and rows are taken in key order until the
    sum of sizes meets the rest (the row that crosses it is taken if at least
    half of it fits).  The order inside a source is never sorted as a whole:
    sums over ``BINS`` key bins, then over ``BINS`` parts of the crossing bin,
    lead to the few rows around the budget, so a source with a third of all
    rows is spread over all tasks.

    Keys depend on the row's id and ``seed`` alone, so reruns agree.  Null and
    empty texts have size 0 and take 0 words; a null source is a source; rows
    that repeat an id draw the same key, follow each other by a hash of their
    text and are counted each; no row is taken more than ``cap`` times; an empty
    table gives no rows.  ``quality`` must be positive (default: surface_quality).
    """
    text = F.col(text_col)
    key = -F.log(uniform(F.col(id_col), seed)) / (quality if quality is not None else surface_quality(text))
    place = key / (1 + key)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(text).alias("size"), place.alias("place"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("tie"))
    bin1 = F.least(F.floor(F.col("place") * BINS), F.lit(BINS - 1))
    rows = rows.withColumn("bin1", bin1)
    rows = materialise(rows.withColumn("bin2", F.floor((F.col("place") * BINS - F.col("bin1")) * BINS)), "mix-keys")

    plan = source_targets(rows, weights, share, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs)
    plan = materialise(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-plan")

    def crossing(binned: DataFrame, name: str) -> DataFrame:
        """Per source, the bin in which the rest ends and the words of the bins before it."""
        start = F.sum("words").over(W.partitionBy("source").orderBy(name)) - F.col("words")
        return (binned.withColumn("start", start + F.col("base")).where("start <= rest and rest < start + words")
                .groupBy("source").agg(F.min(F.struct(name, "start")).alias("at"), F.first("rest").alias("rest"))
                .select("source", "rest", f"at.{name}", F.col("at.start").alias("base")))

    first = _by_source(rows.groupBy("source", "bin1").agg(F.sum("size").alias("words")),
                       plan.select("source", "rest", F.lit(0).cast("long").alias("base")))
    first = crossing(first, "bin1")
    inside = _by_source(rows, first.select("source", F.col("bin1").alias("cross1"), "rest", "base")).where("bin1 = cross1")
    second = inside.groupBy("source", "bin2", "cross1", "rest", "base").agg(F.sum("size").alias("words"))
    second = crossing(second, "bin2")
    cut = materialise(_by_source(plan, first.select("source", F.col("bin1").alias("cross1")))
                      .join(second.select(F.col("source").alias("s2"), F.col("bin2").alias("cross2"), "base"),
                            F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2"), "mix-cut")

    rows = _by_source(rows, cut)
    at_cut = (F.col("bin1") == F.col("cross1")) & (F.col("bin2") == F.col("cross2"))
    before = (F.col("bin1") < F.col("cross1")) | ((F.col("bin1") == F.col("cross1")) & (F.col("bin2") < F.col("cross2")))
    # Only the rows around the budget are sorted: one bin of BINS * BINS of a source.
    start = F.col("base") + F.sum("size").over(W.partitionBy("source").orderBy("place", "doc_id", "tie")
                                               .rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    some = F.col("rest") > 0   # nothing is left to take where the target is whole epochs
    near = rows.where(at_cut).withColumn("more", F.when(some & (start + F.col("size") / 2 <= F.col("rest")), 1).otherwise(0))
    far = rows.where(~F.coalesce(at_cut, F.lit(False))).withColumn("more", F.when(some & before, 1).otherwise(0))
    copies = (F.col("epochs") + F.col("more")).cast("long")
    return near.unionByName(far).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                                        (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with each row as often as ``mix`` takes it; rows that repeat an id are taken as one of them is.

    Every stage keeps its columns; a row of a null id is taken like the other rows of null id.
    """
    plan = (mix(docs, id_col=id_col, **options).groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies"))
            .where("__copies > 0"))
    rows = docs.join(plan, docs[id_col].eqNullSafe(plan["__id"]))
    times = F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))
    return rows.select(*[docs[c] for c in docs.columns], times.alias("__time")).drop("__time")


def _by_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Left join on the source, nulls being equal."""
    right = per_source.withColumnRenamed("source", "__source")
    return rows.join(right, rows["source"].eqNullSafe(right["__source"]), "left").drop("__source")
