"""Wide → long reshaping.

``unpivot`` plans as ``Expand``: filters on the id push down to the scan, a
filter on the value column stays above ``Expand``, so value filters are applied
right after and only the needed columns are unpivoted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.functions.labels import canonical_id, value_key
from wardline.operators.columns import drop_columns
from wardline.sources.model import FILE_COL


def unpivot_values(df: DataFrame, ids: list[str], values: list[str], name_col: str = "name",
                   value_col: str = "value") -> DataFrame:
    """Unpivot ``values`` into (``name_col``, ``value_col``) rows, all as text.

    Mixed column types fail analysis in ``unpivot``, so values become strings.
    """
    if not values:
        raise ValueError("no columns to unpivot")
    cast = df.select(*ids, *[ref(c).cast("string").alias(c) for c in values])
    return cast.unpivot([ref(c) for c in ids], [ref(c) for c in values], name_col, value_col)


def melt_onehot(df: DataFrame, id_column: str, exclude: Iterable[str] | None = None, positive="1",
                name_col: str = "comorb_name", id_alias: str = "patient_id") -> DataFrame:
    """One-hot columns → distinct (id, name) links where the flag is positive.

    Every column other than the id (and ``exclude``) is a flag column.  ``1``,
    ``1.0`` and `` 1 `` all count as positive.
    """
    df = drop_columns(df, exclude)
    flags = [c for c in df.columns if c not in (id_column, FILE_COL)]
    long = unpivot_values(df, [id_column], flags, name_col, "__wl_status")
    positive_key = value_key(F.lit(str(positive)))
    return (long.where(value_key(F.col("__wl_status")) == positive_key)
            .select(canonical_id(ref(id_column)).alias(id_alias), name_col)
            .distinct())
