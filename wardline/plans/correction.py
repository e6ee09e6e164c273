"""Value correction.

Gather each entity's distinct values per file, reduce them to one corrected
value with a user aggregate, join it back onto every source row and write the
result to a new location.  The input files are never overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.labels import canonical_id, number
from wardline.functions.refs import ref
from wardline.operators.columns import AGE_TERMS, match_columns
from wardline.operators.resolve import gather_values
from wardline.operators.user_aggregate import UserAggregate, aggregate_by
from wardline.session import checkpoint_dir
from wardline.sources.files import glob_safe, list_folder
from wardline.sources.model import FILE_COL, Source, SourceSet


def python_correction(fn: Callable[[list], object], return_type: str = "double", most: int = 100_000) -> Callable[[Column], Column]:
    """Wrap a Python ``list of values → value`` function as a grouped aggregate.

    Runs as an Arrow-batched pandas UDF over each entity's distinct values per
    file, all of which one task holds: an entity with over ``most`` of them
    fails the job.  Prefer a Spark aggregate (``F.max``, ``F.median`` ...), which
    combines on the map side and never leaves the JVM, or a ``UserAggregate``,
    which has no such limit.
    """
    @F.pandas_udf(return_type)
    def _agg(values: pd.Series) -> object:
        if len(values) > most:
            raise ValueError(f"an entity has {len(values)} values, a Python correction takes {most}; use a Spark aggregate")
        return fn(values.tolist())

    return _agg


def corrected_values(sources: SourceSet, correction: Callable | UserAggregate, column_search_terms: Sequence[str] | None = None,
                     id_alias: str | None = None, kind: str = "spark", value_type: str = "double") -> DataFrame:
    """(id, corrected): one value per entity from its gathered values (A11 + V1).

    ``correction`` gets numbers: ``kind="spark"`` takes a function from a
    Column to an aggregate (``F.max``), ``kind="python"`` one from a list to a
    value; a ``UserAggregate`` runs as partial states that merge, whatever the
    number of an entity's values, and needs no ``kind``.  With ``value_type="double"`` (the default) text that is not a
    number fails the job; ``"string"`` hands over the text.
    """
    if kind not in ("spark", "python"):
        raise ValueError(f"unknown kind of correction {kind!r}; known: spark, python")
    if value_type not in ("double", "string"):
        raise ValueError(f"unknown value type {value_type!r}; known: double, string")
    idc = id_alias or sources.id_column
    gathered = gather_values(sources, column_search_terms or AGE_TERMS, id_alias=idc)
    value = F.col("value")
    if value_type == "double":
        blank = F.trim(value) == ""
        bad = F.raise_error(F.concat(F.lit("Value is not a number for "), ref(idc), F.lit(": "), value)).cast("double")
        gathered = gathered.where(~blank).withColumn("value", F.when(number(value).isNull(), bad).otherwise(number(value)))
    if isinstance(correction, UserAggregate):
        return aggregate_by(gathered, idc, "value", correction, value_type, "corrected")
    aggregate = correction if kind == "spark" else python_correction(correction, value_type)
    return gathered.groupBy(idc).agg(aggregate(F.col("value")).alias("corrected"))


def apply_correction(sources: SourceSet, corrected: DataFrame,
                     column_search_terms: Sequence[str] | None = None) -> SourceSet:
    """Replace the matched column of every source with the corrected value.

    A source without the column passes through unchanged (D11); more than
    one matching column is an error.  A row whose entity has no corrected
    value fails the job naming the id; a row without an id stays as it is.
    """
    terms = column_search_terms or AGE_TERMS
    idc = sources.id_column
    # One row per entity, materialised once in the shared checkpoint folder:
    # every source joins it, and as a plain scan it lets adaptive execution
    # split a hot entity's partition on the (large) source side of the join.
    checkpoint_dir(corrected.sparkSession)
    fixed = corrected.select(ref(corrected.columns[0]).alias("_cid"),
                             F.col("corrected").alias("_corrected")).checkpoint()
    out = []
    for s in sources:
        cols = match_columns(s.columns, terms)
        if not cols:
            out.append(s)
            continue
        if len(cols) > 1:
            raise ValueError(f"Multiple value columns found {cols}")
        target = cols[0]
        joined = s.df.join(fixed, ref(s.id_column) == F.col("_cid"), "left")
        missing = F.raise_error(F.concat(F.lit("No corrected value found for "), ref(s.id_column)))
        value = F.when(ref(s.id_column).isNull(), ref(target).cast("string"))
        value = value.when(F.col("_cid").isNull(), missing.cast("string")).otherwise(F.col("_corrected").cast("string"))
        new_cols = [value.alias(c) if c == target else ref(c) for c in s.df.columns]
        out.append(s.with_df(joined.select(*new_cols)))
    return SourceSet(out, idc)


def write_sources(sources: SourceSet, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write corrected sources to a new folder, one sub-folder per file, named after it (K7)."""
    for i, s in enumerate(sources):
        w = s.df.write.mode(mode).partitionBy(FILE_COL)
        target = f"{path.rstrip('/')}/group={i}"
        if fmt == "csv":
            w.option("header", True).option("escape", '"').csv(target)
        else:
            w.format(fmt).save(target)


def read_sources(spark: SparkSession, path: str, id_column: str) -> SourceSet:
    """Sources that ``write_sources`` wrote as CSV, under the file names they had.

    The names come from the folders, so keyword selection prunes before the scan.
    """
    sources = []
    for group in sorted(list_folder(spark, path), key=lambda f: f.name):
        if not group.name.startswith("group="):
            continue
        names = tuple(sorted(unquote(f.name.split("=", 1)[1]) for f in list_folder(spark, group.path) if f.name.startswith(f"{FILE_COL}=")))
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        header = reader.csv(glob_safe(group.path)).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = reader.schema(schema).csv(glob_safe(group.path))
        cols = [canonical_id(ref(id_column)).alias(id_column), *[ref(c) for c in header if c != id_column]]
        sources.append(Source(df.select(*cols), id_column, names))
    return SourceSet(sources, id_column)
