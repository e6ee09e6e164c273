"""Adapters from existing tables (Parquet, catalog tables) to the source model.

A table plays the part of one file, or of many files when a column names the
file each row belongs to.  Columns keep their native types; operators compare
values by ``value_key`` so typed and text columns mix safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.functions.labels import canonical_id
from wardline.sources.model import FILE_COL, Source, SourceSet


def from_table(df: DataFrame, id_column: str, source_id: str | None = None, file: str | None = None,
               file_column: str | None = None, columns: list[str] | None = None,
               rename: dict[str, str] | None = None) -> Source:
    """Wrap ``df`` as a ``Source``.

    ``source_id`` is the column holding the entity id (renamed to
    ``id_column``); ``file`` names the whole table as one file, or
    ``file_column`` tags each row with its own file name.  ``columns``
    restricts the payload (pruning reaches the scan).
    """
    if (file is None) == (file_column is None):
        raise ValueError("give exactly one of file= or file_column=")
    src = source_id or id_column
    payload = columns if columns is not None else [c for c in df.columns if c not in (src, file_column)]
    rename = rename or {}
    tag = F.lit(file) if file is not None else F.col(file_column).cast("string")
    cols = [canonical_id(ref(src)).alias(id_column)]
    cols += [ref(c).alias(rename.get(c, c)) for c in payload if c != src]
    cols.append(tag.alias(FILE_COL))
    return Source(df.select(*cols), id_column, (file,) if file is not None else None)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` from a directory of ``<name>.parquet`` files."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
