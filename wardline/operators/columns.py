"""Column discovery and projection.

Column names are metadata: matching runs on the driver over ``df.columns``
and only the resulting ``select`` reaches the cluster, so the scan reads just
the matched columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref

# Default column-name patterns.  A name matches when one pattern
# matches at its start, ignoring case.  The patterns match the keyword as a
# whole token separated by '.', '_' or '-' ("age", "AGE", "age_years",
# "patient_age", "age-1"), never inside a word ("Stage", "ageing", "percentage").
AGE_TERMS = [r"(?:.*[._\-])?age(?:[._\-].*)?$"]
GENDER_TERMS = [r"(?:.*[._\-])?gender(?:[._\-].*)?$", r"(?:.*[._\-])?sex(?:[._\-].*)?$"]
COVID_TERMS = ["covid_status", "covid", "covid19"]


def match_columns(columns: Iterable[str], patterns: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    """Columns where any pattern matches at the start, ignoring case."""
    compiled = [re.compile(p, re.IGNORECASE) for p in patterns]
    skip = set(exclude)
    return [c for c in columns if c not in skip and any(p.match(c) for p in compiled)]



def drop_columns(df: DataFrame, exclude: Iterable[str] | None) -> DataFrame:
    """Drop columns that must exist."""
    if not exclude:
        return df
    exclude = list(exclude)
    missing = [c for c in exclude if c not in df.columns]
    if missing:
        raise AssertionError(f"Columns to exclude do not exist in target file(s): {missing}")
    return df.drop(*exclude)
