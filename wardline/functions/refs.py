"""Exact column references for names that come from file headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """The column called exactly ``name``: dots are not read as struct access."""
    return F.col("`" + name.replace("`", "``") + "`")
