"""Fill-in-the-middle by a counted-quantifier regular expression (DataFrame functions only).

``regexp_count`` gives the n units (code points) of a text.  Two cuts a <= b of
0..n, drawn from a hash of the row's id, go into a pattern of that row,
``\\A(unit{a}+)(unit{b-a}+)(rest*+)\\z``, whose possessive groups capture prefix,
middle and suffix in one match without backtracking; the replacement writes
them in the order of the form.  ``restore`` undoes it by one match, too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT = "(?s:.)"
MARKERS = ("<P>", "<S>", "<M>")  # of prefix, suffix and middle


def _check(markers: Sequence[str]) -> tuple[str, str, str]:
    """Markers between which texts without markers can be told apart: none can begin inside another one."""
    prefix, suffix, middle = markers
    if any(not m for m in markers) or len({m[0] for m in markers} & set("".join(m[1:] for m in markers))):
        raise ValueError(f"a marker is empty, or its first character comes again inside a marker: {markers}")
    if any(a != b and a.startswith(b) for a in markers for b in markers) or len(set(markers)) < 3:
        raise ValueError(f"a marker begins another one: {markers}")
    return prefix, suffix, middle


def _plain(marker: str) -> str:
    """``marker`` as a replacement text."""
    return re.sub(r"([\\$])", r"\\\1", marker)


def _regex(marker: str) -> str:
    """``marker`` as a pattern."""
    return re.sub(r"([^A-Za-z0-9<>\s])", r"\\\1", marker)


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first 8-digit groups of the SHA-256 of ``seed:key`` (a null key: ``null``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, seed: int = 1, markers: Sequence[str] = MARKERS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, output, prefix_chars, middle_chars`` for every row of ``docs``.

    ``form`` is ``plain`` (the output is the text) for texts that are empty or
    hold a marker and for ``plain_percent`` of the others; of the rest
    ``spm_percent`` are ``spm`` (suffix, prefix, middle) and the others ``psm``
    (prefix, suffix, middle).  Cuts and form depend on id and ``seed`` alone, so
    reruns agree, and rows that repeat an id are cut each by its own length.

    A null text counts as empty, a null id draws as ``null``; texts of any
    length are cut whole, one row at a time; other columns are not read; an
    empty table gives no rows.
    """
    prefix, suffix, middle = _check(markers)
    h1, h2, h3, h4 = (F.col(f"h{i}") for i in range(1, 5))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *[h.alias(f"h{i + 1}") for i, h in enumerate(draws(F.col(id_col), seed))])
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(_UNIT)).cast("long"))
    marked = F.contains("text", F.lit(prefix)) | F.contains("text", F.lit(suffix)) | F.contains("text", F.lit(middle))
    form = (F.when((F.col("n") == 0) | marked | (h3 % 100 >= 100 - plain_percent), "plain")
            .when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    rows = rows.withColumns({"form": form, "a": F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)),
                             "b": F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))})
    size = F.col("b") - F.col("a")
    pattern = F.concat(F.lit(rf"\A({_UNIT}{{"), F.col("a"), F.lit(rf"}}+)({_UNIT}{{"), size, F.lit(rf"}}+)({_UNIT}*+)\z"))
    p, s, m = map(_plain, (prefix, suffix, middle))
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.regexp_replace("text", pattern, order)).otherwise(F.col("text")).alias("output"),
                       F.when(cut, F.col("a")).alias("prefix_chars"), F.when(cut, size).alias("middle_chars"))


def restore(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text of an ``output`` of ``fill_middle`` and its ``form``; null for a null."""
    prefix, suffix, middle = _check(markers)
    p, s, m = map(_regex, (prefix, suffix, middle))
    part = f"({_UNIT}*?)"  # the first marker of its kind ends it: a text that holds one is plain
    return (F.when(form == "psm", F.regexp_replace(output, F.lit(rf"\A{p}{part}{s}{part}{m}({_UNIT}*+)\z"), F.lit("$1$3$2")))
            .when(form == "spm", F.regexp_replace(output, F.lit(rf"\A{s}{part}{p}{part}{m}({_UNIT}*+)\z"), F.lit("$2$3$1")))
            .otherwise(output))
