"""Value normalisation as Column builders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens that pandas reads as missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Default integer codes for gender.
DEFAULT_GENDER_CODES = {0: "M", 1: "F"}


# Text that reads as a number: digits with an optional sign, point and exponent.
NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def number(col: Column | str) -> Column:
    """Trimmed text as a double; null unless all of it is a number (``12d`` and ``5F`` are not)."""
    text = F.trim(_c(col).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def null_tokens(col: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Text → null when, trimmed, it is one of the missing-value tokens."""
    c = _c(col).cast("string")
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def canonical_id(col: Column | str, strip_float_suffix: bool = False) -> Column:
    """Id as trimmed text; leading zeros stay.

    ``strip_float_suffix`` turns ``12.0`` into ``12`` for ids that went
    through a spreadsheet number cell.
    """
    c = F.trim(_c(col).cast("string"))
    if strip_float_suffix:
        c = F.regexp_replace(c, r"^(-?\d+)\.0+$", "$1")
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def value_key(col: Column | str) -> Column:
    """Comparison key of a value (D3): numbers compare as numbers, text trimmed.

    ``34``, ``34.0`` and `` 34 `` share one key; text keeps its case.  Whole
    numbers of more digits than a double holds are compared digit by digit.
    """
    text = F.trim(_c(col).cast("string"))
    text = F.when(text == "", F.lit(None).cast("string")).otherwise(text)
    whole = F.regexp_extract(text, r"^[+-]?0*([0-9]*)(?:\.0*)?$", 1)
    long = F.length(whole) > 15
    exact = F.concat(F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")), whole)
    value = number(text)
    return F.when(long, exact).when(value.isNotNull(), value.cast("string")).otherwise(text)


def regex_any(col: Column | str, patterns: Iterable[str], anchored: bool = True,
              ignore_case: bool = True) -> Column:
    """True when any pattern matches the value.

    ``anchored`` mirrors a prefix match: the pattern must match at the start,
    not necessarily to the end.  Java and Python agree on the syntax used by
    the default patterns.  Null in → null out.
    """
    patterns = list(patterns)
    if not patterns:
        return F.lit(False)
    body = "|".join(f"(?:{p})" for p in patterns)
    flags = "(?i)" if ignore_case else ""
    regex = f"{flags}^(?:{body})" if anchored else f"{flags}(?:{body})"
    return _c(col).cast("string").rlike(regex)


def contains_ci(col: Column | str, keyword: str) -> Column:
    """Case-insensitive substring test (F9), for file names and keywords."""
    return F.lower(_c(col)).contains(keyword.lower())


def label_map(col: Column | str, mapping: Mapping) -> Column:
    """Look a value up in a literal mapping (F10); missing key → null."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(col))


def normalise_gender(col: Column | str, int_mappings: Mapping[int, str] | None = None,
                     entity: Column | str | None = None, on_unmapped: str = "raise") -> Column:
    """Gender text or code → ``M``/``F``/``U``.

    Numbers go through ``int_mappings`` (default 0 → M, 1 → F); a number with
    no mapping raises (``on_unmapped='raise'``) or gives ``U``.  Text starting
    with ``m`` gives M, with ``f`` gives F, anything else U.  Null stays null so
    that a table default can apply.
    """
    mapping = DEFAULT_GENDER_CODES if int_mappings is None else dict(int_mappings)
    text = F.trim(_c(col).cast("string"))
    value = number(text)
    is_number = value.isNotNull()
    code = value.try_cast("long")           # truncates toward zero, as int() of a float does
    mapped = label_map(code, {int(k): v for k, v in mapping.items()})
    if on_unmapped == "raise":
        who = F.coalesce(_c(entity).cast("string"), F.lit("?")) if entity is not None else F.lit("?")
        unmapped = F.raise_error(F.concat(F.lit("No gender is mapped to code "), text, F.lit(" (patient "), who, F.lit(")")))
    else:
        unmapped = F.lit("U")
    return (F.when(text.isNull(), F.lit(None).cast("string"))
            .when(is_number, F.coalesce(mapped, unmapped))
            .when(text.rlike("(?i)^m"), F.lit("M"))
            .when(text.rlike("(?i)^f"), F.lit("F"))
            .otherwise(F.lit("U")))
