"""Nested patient documents in bounded pages.

A document's children come in order, at most ``page_size`` of them in one row,
so a patient with a long history has many pages instead of one huge row.  The
children of all patients are sorted by range once; a child's number is the
number of its patient's children in earlier ranges, from counts per (patient,
range), plus its place within its own range.  No window or list ever holds more
of a patient than one range or one page does, and a patient with a third of all
children lies in a third of the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.session import checkpoint_dir

# The order of a patient's children: by time, then by what they are; nulls first.
ORDER = ("date", "time", "child", "name", "value")


def numbered_children(children: DataFrame, order: Sequence[str] = ORDER, id_column: str = "patient_id", ranges: int | None = None) -> DataFrame:
    """``children`` with ``position``, 1 to n within each patient, in the order of ``order``.

    Rows that agree in the whole order are numbered in any order.  ``ranges``
    is the number of sorted ranges (default: ``spark.sql.shuffle.partitions``);
    the ranged rows are checkpointed once, so that numbers and rows belong
    together also when a task is tried again.
    """
    spark = children.sparkSession
    taken = {"position", "_range", "_place"} & set(children.columns)
    if taken:
        raise ValueError(f"columns of these names are added here: {sorted(taken)}")
    checkpoint_dir(spark)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [ref(id_column), *[ref(c) for c in order]]
    # The last key spreads rows that agree in all others over ranges.
    dealt = children.where(ref(id_column).isNotNull()).withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
    dealt = dealt.repartitionByRange(n, *keys, F.col("_place")).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = dealt.groupBy(ref(id_column).alias("_id"), F.col("_range").alias("_in")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_id").orderBy("_in")) - F.col("_n")
    offsets = counts.select("_id", "_in", before.alias("_before")).checkpoint()
    within = F.row_number().over(W.partitionBy("_range", ref(id_column)).orderBy(*[ref(c) for c in order], "_place"))
    placed = dealt.withColumn("_place", within)
    same = (F.col("_range") == F.col("_in")) & (ref(id_column) == F.col("_id"))
    rows = placed.join(offsets, same).withColumn("position", F.col("_before") + F.col("_place"))
    return rows.select(*[ref(c) for c in children.columns], "position")


def patient_pages(children: DataFrame, page_size: int = 1000, order: Sequence[str] = ORDER, id_column: str = "patient_id",
                  ranges: int | None = None) -> DataFrame:
    """``patient_id, page, first_position, n_children, first_date, last_date, children``: a row per patient and page.

    ``children`` are rows as of ``patient_children``; each page nests at most
    ``page_size`` of them as an array of structs in order.  Patients without
    children have no pages; children without a patient are left out.
    """
    if page_size < 1:
        raise ValueError("a page holds at least one child")
    rows = numbered_children(children, order, id_column, ranges)
    payload = [c for c in children.columns if c != id_column]
    page = (F.floor((F.col("position") - 1) / page_size) + 1).cast("long").alias("page")
    nested = F.sort_array(F.collect_list(F.struct("position", *[ref(c) for c in payload]))).alias("_rows")
    dates = [F.min("date").alias("first_date"), F.max("date").alias("last_date")] if "date" in payload else []
    pages = rows.groupBy(ref(id_column), page).agg(nested, *dates)
    body = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in payload])).alias("children")
    return pages.select(ref(id_column), "page", F.col("_rows")[0]["position"].alias("first_position"), F.size("_rows").cast("long").alias("n_children"),
                        *[c for c in ("first_date", "last_date") if dates], body)
