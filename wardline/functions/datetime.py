"""Day-first date/time parsing as pure Column expressions.

``with_parsed_datetime`` adds the calendar date and the minutes since midnight
(seconds dropped; a trailing ``Z`` or offset is read over, times are as written).  Text holding only a
date gives a null time.  Text that cannot be read gives null for both.

Everything is regex extraction plus ``try_to_date``: no time zone is involved
(a date has none and the minutes are computed from the text), no Python runs
per row, and invalid input never raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref

# Accepted layouts of the date part, each rewritten to
# "year-month-day<SEP>rest of text".
#   day/month/year with separator '/', '.' or '-' and a 4- or 2-digit year
#   ISO year-month-day
#   day, month name (3 letters or full), 4-digit year
_SEP = "\u0001"
_TAIL = r"(?:(?:\s+|T)(.*))?$"
_LAYOUTS = (
    (r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})" + _TAIL, "$3-$2-$1" + _SEP + "$4"),
    (r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{2})" + _TAIL, "20$3-$2-$1" + _SEP + "$4"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _TAIL, "$1-$2-$3" + _SEP + "$4"),
    (r"^(\d{1,2})[\s\-]+([A-Za-z]{3,9})\.?,?[\s\-]+(\d{4})(?:,?\s+(.*))?$", "$3-$2-$1" + _SEP + "$4"),
)
# Accepted layouts of the time part.
#   24-hour H:mm with optional :ss and fraction
#   12-hour h, h:mm or h:mm:ss followed by am/pm
_T24 = r"^\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?$"
_ZONE = r"(?<=\d)\s*(?:[zZ]|[+-]\d{2}:?\d{2})$"
_T12 = r"^\d{1,2}(?::\d{2})?(?::\d{2})?\s*[aApP]\.?[mM]\.?$"


def _normalise(s: Column) -> Column:
    """Rewrite the first matching layout; null when none matches.

    ``regexp_replace`` leaves text it does not match unchanged, so
    ``nullif(rewritten, s)`` is null exactly when the layout does not apply;
    ``coalesce`` stops at the first layout that does, one regex per layout tried.
    """
    return F.coalesce(*[F.nullif(F.regexp_replace(s, pattern, target), s) for pattern, target in _LAYOUTS])


# English month names, matched on their first three letters.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH_NAME = r"(?i)^(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)$"


def _date_of(y: Column, mtext: Column, d: Column, n_parts: Column) -> Column:
    """Year, month (number or English name) and day → date, or null.

    Validated arithmetically and built with ``make_date`` only when valid, so
    no parser exception is thrown per row and ANSI mode never raises.
    """
    by_name = F.when(mtext.rlike(_MONTH_NAME),
                     F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.lower(F.substring(mtext, 1, 3))))
    m = F.coalesce(mtext.try_cast("int"), by_name.cast("int"))
    ym_ok = (n_parts == 3) & y.between(1, 9999) & m.between(1, 12)
    month_len = F.when(ym_ok, F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1)))))
    ok = ym_ok & (d >= 1) & (d <= month_len)
    return F.when(ok, F.make_date(y, m, d))


def with_parsed_datetime(df: DataFrame, text: Column | str, date_col: str, time_col: str) -> DataFrame:
    """Add ``date_col`` (date) and ``time_col`` (minutes, double) parsed from ``text`` (F1).

    Staged over a few projections: each intermediate column is referenced more
    than once, so Catalyst keeps the projections apart and every regex and
    split runs once per row, instead of being inlined into each place that uses
    the date or the minutes.
    """
    c = F.col(text) if isinstance(text, str) else text
    tmp = ["__wl_dt_norm", "__wl_dt_ymd", "__wl_dt_rest", "__wl_dt_y", "__wl_dt_m", "__wl_dt_d", "__wl_dt_n", "__wl_dt_date", "__wl_dt_kind", "__wl_dt_parts", "__wl_dt_pm", "__wl_dt_min"]
    out = df.withColumn("__wl_dt_norm", _normalise(F.trim(c.cast("string"))))
    out = out.select("*", F.split(F.substring_index("__wl_dt_norm", _SEP, 1), "-").alias("__wl_dt_ymd"),
                     F.regexp_replace(F.trim(F.substring_index("__wl_dt_norm", _SEP, -1)), _ZONE, "").alias("__wl_dt_rest"))
    ymd = F.col("__wl_dt_ymd")
    out = out.select("*", F.array_size(ymd).alias("__wl_dt_n"), F.try_element_at(ymd, F.lit(1)).try_cast("int").alias("__wl_dt_y"),
                     F.try_element_at(ymd, F.lit(2)).alias("__wl_dt_m"), F.try_element_at(ymd, F.lit(3)).try_cast("int").alias("__wl_dt_d"))
    rest = F.col("__wl_dt_rest")
    kind = (F.when(rest.isNull() | (rest == ""), F.lit(0)).when(rest.rlike(_T24), F.lit(24))
            .when(rest.rlike(_T12), F.lit(12)).otherwise(F.lit(-1)))
    out = out.select("*", _date_of(F.col("__wl_dt_y"), F.col("__wl_dt_m"), F.col("__wl_dt_d"), F.col("__wl_dt_n")).alias("__wl_dt_date"), kind.alias("__wl_dt_kind"))
    twelve = F.col("__wl_dt_kind") == 12
    # Only 12-hour text needs its am/pm suffix removed; a fraction of a second
    # in 24-hour text lands in the seconds field, which is only range-checked.
    core = F.when(twelve, F.regexp_replace(rest, r"\s*[aApP]\.?[mM]\.?$", "")).otherwise(rest)
    out = out.select("*", F.split(core, ":").alias("__wl_dt_parts"),
                     (twelve & F.lower(rest).rlike(r"p\.?m\.?$")).alias("__wl_dt_pm"))
    parts = F.col("__wl_dt_parts")
    h = F.try_element_at(parts, F.lit(1)).try_cast("int")
    m = F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("int"), F.lit(0))
    sec = F.coalesce(F.regexp_extract(F.try_element_at(parts, F.lit(3)), r"^[0-9]+", 0).try_cast("int"), F.lit(0))
    k = F.col("__wl_dt_kind")
    ok = (((k == 24) & (h < 24)) | ((k == 12) & (h >= 1) & (h <= 12))) & (m < 60) & (sec < 60)
    hour = F.when(k == 24, h).otherwise(h % 12 + F.when(F.col("__wl_dt_pm"), 12).otherwise(0))
    minutes = F.when(k == 0, F.lit(None)).when(ok, hour * 60 + m).otherwise(F.lit(-1)).cast("double")
    out = out.withColumn("__wl_dt_min", minutes)
    valid = F.col("__wl_dt_date").isNotNull() & (F.col("__wl_dt_min").isNull() | (F.col("__wl_dt_min") >= 0))
    return (out.withColumn(date_col, F.when(valid, F.col("__wl_dt_date")))
            .withColumn(time_col, F.when(valid, F.col("__wl_dt_min"))).drop(*tmp))


def render_date(col: Column | str) -> Column:
    """Legacy text rendering of a date: day/month/year, not zero-padded (F2)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "d/M/yyyy")


def join_datetime(cols: list[str] | str) -> Column:
    """Join a date column and a time column with one space.

    A null date part gives null (the date check of the caller then rejects the
    row); a null time part leaves just the date.
    """
    if isinstance(cols, str):
        return ref(cols).cast("string")
    first, *others = cols
    joined = F.concat_ws(" ", *[ref(c).cast("string") for c in cols])
    return F.when(ref(first).isNull(), F.lit(None).cast("string")).otherwise(joined) if others else ref(first)
