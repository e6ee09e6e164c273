"""Text helpers as Column builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_quote(text: str) -> str:
    """Escape text so a Java regex matches it literally."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in text)


def split_literal(col: Column | str, sep: str = " ") -> Column:
    """Split on a literal separator (F7); Spark's ``split`` takes a regex."""
    return F.split(_c(col).cast("string"), java_quote(sep))


def within_edit_distance(a: Column | str, b: Column | str, threshold: int) -> Column:
    """True when the case-sensitive edit distance is at most ``threshold``.

    The three-argument ``levenshtein`` stops early and returns -1 beyond the
    threshold, so the cost is bounded by the threshold, not the string length.
    """
    return F.levenshtein(_c(a), _c(b), int(threshold)) >= 0


def similarity(a: Column | str, b: Column | str, threshold: int = 1) -> Column:
    """1 when within ``threshold`` edits, else 0 (the dictionary similarity score)."""
    return within_edit_distance(a, b, threshold).cast("int")


def clean_label(col: Column | str) -> Column:
    """Trimmed text."""
    return F.trim(_c(col).cast("string"))


def ref_range(bounds: Sequence[float] | None) -> Column:
    """``[low, high]`` as array<double>; the length is checked."""
    if bounds is None:
        return F.lit(None).cast("array<double>")
    if len(bounds) != 2:
        raise ValueError("ref_range should be a list of length two: lower then upper threshold")
    return F.array(F.lit(float(bounds[0])), F.lit(float(bounds[1])))
