"""Fact builders: events, measurements, critical-care stays, comorbidities.

Each builder is one lazy DataFrame chain over the source rows: project, parse,
type and validate in the JVM.  Validation that must stop a load runs inline
with ``raise_error`` (no extra pass) except the parent check (J2), which reads
only the id column once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from warnings import warn

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.functions.datetime import join_datetime, with_parsed_datetime
from wardline.functions.labels import canonical_id, label_map, number, value_key
from wardline.functions.text import clean_label, split_literal
from wardline.operators.columns import drop_columns
from wardline.operators.fuzzy import resolve_names
from wardline.operators.reshape import melt_onehot
from wardline.operators.validate import assert_parents
from wardline.schemas import conform
from wardline.sources.model import FILE_COL, SourceSet, union_sources

EVENT_FIELDS = ("event_type", "component", "covid_status", "death", "critical_care_admission", "source",
                "source_type", "destination", "wimd")
RESULT_TYPES = ("continuous", "discrete", "complex")
TEMP = "__wl_"  # columns that a builder adds for a while


def _whole(c: Column, pid: Column, field: str) -> Column:
    """Text as a whole number; text that is not a number fails the load."""
    bad = F.raise_error(F.concat(F.lit(f"{field} is not a number for patient "), F.coalesce(pid, F.lit("?")), F.lit(": "), c.cast("string")))
    return F.when(c.isNotNull() & (F.trim(c.cast("string")) != "") & number(c).isNull(), bad.cast("int")).otherwise(number(c).cast("int"))


def load_keyword(sources: SourceSet, keyword: str) -> DataFrame:
    """Union of every file whose name contains ``keyword`` (U1 + S7)."""
    return union_sources(sources.select_keyword(keyword), keyword=keyword)


def _extra(df: DataFrame, used: set[str]) -> Column:
    rest = [c for c in df.columns if c not in used and c != FILE_COL and not c.startswith(TEMP)]
    if not rest:
        return F.lit(None).cast("map<string,string>")
    return F.map_from_arrays(F.array(*[F.lit(c) for c in rest]),
                             F.array(*[ref(c).cast("string") for c in rest]))


def build_events(df: DataFrame, id_column: str, event_datetime: str | Sequence[str],
                 mappings: Mapping[str, str], exclude_columns: Sequence[str] | None = None,
                 patients: DataFrame | None = None, keep_extra: bool = True) -> DataFrame:
    """Outcome rows → ``events``.

    ``mappings`` maps event fields to source columns and must name
    ``event_type``.  ``event_datetime`` is one column or a [date, time] pair
    (joined by a space, F3).  An unreadable date, or text in a numeric field,
    fails the load naming the patient and the text; the type is trimmed;
    defaults fill the rest.
    Columns not mapped go to ``extra`` (dynamic attributes).
    """
    if "event_type" not in mappings:
        raise AssertionError("mappings must name a source column for event_type")
    unknown = set(mappings) - set(EVENT_FIELDS)
    if unknown:
        raise ValueError(f"Unknown event fields in mappings: {sorted(unknown)}")
    df = drop_columns(df, exclude_columns)
    if patients is not None:
        assert_parents(df, patients, id_column)
    dt_cols = [event_datetime] if isinstance(event_datetime, str) else list(event_datetime)
    df = with_parsed_datetime(df.withColumn("__wl_ev_text", join_datetime(dt_cols)), "__wl_ev_text", "__wl_ev_date", "__wl_ev_time")
    pid = canonical_id(ref(id_column))
    bad_date = F.raise_error(F.concat(F.lit("Invalid event datetime for patient "), F.coalesce(pid, F.lit("?")),
                                      F.lit(": "), F.coalesce(F.col("__wl_ev_text"), F.lit("null"))))
    cols = [pid.alias("patient_id"),
            F.when(F.col("__wl_ev_date").isNull(), bad_date.cast("date")).otherwise(F.col("__wl_ev_date")).alias("event_date"),
            F.col("__wl_ev_time").alias("event_time")]
    for fld, src in mappings.items():
        c = ref(src)
        if fld == "event_type":
            c = clean_label(c)
        elif fld in ("death", "critical_care_admission", "wimd"):
            c = _whole(c, pid, fld)
        cols.append(c.alias(fld))
    if keep_extra:
        cols.append(_extra(df, {id_column, *dt_cols, *mappings.values()}).alias("extra"))
    return conform(df.select(*cols), "events")


def build_measurements(df: DataFrame, id_column: str, results_columns: Sequence[str],
                       results_types: Sequence[str], result_datetime: str | Sequence[str] | None = None,
                       ref_ranges: Sequence[Sequence[float] | None] | None = None,
                       request_source: str | None = None, complex_result_split_char: str = " ",
                       notes: str | None = None, flags: str | None = None, flags_sep: str = ",",
                       patients: DataFrame | None = None, on_invalid: str = "raise") -> DataFrame:
    """Wide result columns → typed long ``measurements``.

    One ``unpivot`` of the result columns; the per-column type and reference
    range come from literal maps keyed by column name (the spec is as wide as
    the header, so no join is needed).  ``continuous`` → double (a value that
    is not a number fails the load, or is dropped with ``on_invalid='drop'``),
    ``discrete`` → text, ``complex`` → text split on a literal separator.
    Empty result cells produce no measurement.  ``notes`` and ``flags`` name
    source columns; flags are split on ``flags_sep`` into a list.
    """
    results_columns, results_types = list(results_columns), list(results_types)
    if len(results_columns) != len(results_types):
        raise AssertionError("results_columns and results_types differ in length")
    bad = [t for t in results_types if t not in RESULT_TYPES]
    if bad:
        raise ValueError(f"unknown result types {sorted(set(bad))}; known: {RESULT_TYPES}")
    if on_invalid not in ("raise", "drop"):
        raise ValueError("on_invalid must be 'raise' or 'drop'")
    ref_ranges = list(ref_ranges or [])
    for r in ref_ranges:
        if r is not None and len(r) != 2:
            raise AssertionError("each reference range needs a lower and an upper bound")
    if patients is not None:
        assert_parents(df, patients, id_column)
    type_of = dict(zip(results_columns, results_types))
    lows = {c: float(r[0]) for c, r in zip(results_columns, ref_ranges) if r is not None}
    highs = {c: float(r[1]) for c, r in zip(results_columns, ref_ranges) if r is not None}

    keep = [ref(id_column).alias("_pid")]
    if result_datetime is not None:
        dt = [result_datetime] if isinstance(result_datetime, str) else list(result_datetime)
        keep.append(join_datetime(dt).alias("_dt"))
    else:
        keep.append(F.lit(None).cast("string").alias("_dt"))
    keep.append((ref(request_source).cast("string") if request_source else F.lit(None).cast("string")).alias("_src"))
    keep.append((ref(notes).cast("string") if notes else F.lit(None).cast("string")).alias("_notes"))
    flag_list = F.transform(split_literal(ref(flags), flags_sep), lambda x: F.trim(x)) if flags else F.lit(None)
    keep.append(flag_list.cast("array<string>").alias("_flags"))
    wide = df.select(*keep, *[ref(c).cast("string").alias(c) for c in results_columns])
    # Parse the datetime once per source row, before the unpivot multiplies rows.
    wide = with_parsed_datetime(wide, "_dt", "_rdate", "_rtime")
    ids = ["_pid", "_dt", "_rdate", "_rtime", "_src", "_notes", "_flags"]
    long = (wide.unpivot(ids, [ref(c) for c in results_columns], "result_name", "_result")
            .where(F.col("_result").isNotNull() & (F.trim("_result") != "")))

    rtype = label_map(F.col("result_name"), type_of)
    value = number("_result")
    pid = canonical_id(F.col("_pid"))
    if on_invalid == "raise":
        not_number = F.raise_error(F.concat(F.lit("Result is not a number for patient "), pid, F.lit(", "),
                                            F.col("result_name"), F.lit(": "), F.col("_result"))).cast("double")
        bad_dt = F.raise_error(F.concat(F.lit("Invalid result datetime for patient "), pid, F.lit(": "),
                                        F.col("_dt"))).cast("date")
    else:
        long = long.where((rtype != "continuous") | value.isNotNull())
        long = long.where(F.col("_dt").isNull() | F.col("_rdate").isNotNull())
        not_number, bad_dt = F.lit(None).cast("double"), F.lit(None).cast("date")
    low, high = label_map(F.col("result_name"), lows), label_map(F.col("result_name"), highs)
    out = long.select(
        pid.alias("patient_id"), "result_name", rtype.alias("result_type"),
        F.when(rtype == "continuous", F.coalesce(value, not_number)).alias("result_double"),
        F.when(rtype == "discrete", F.col("_result")).alias("result_string"),
        F.when(rtype == "complex", split_literal(F.col("_result"), complex_result_split_char)).alias("result_array"),
        F.when(F.col("_dt").isNull(), F.lit(None).cast("date"))
        .otherwise(F.coalesce(F.col("_rdate"), bad_dt)).alias("result_date"),
        F.col("_rtime").alias("result_time"),
        F.col("_src").alias("request_source"),
        F.when(low.isNotNull(), F.array(low, high)).alias("ref_range"),
        F.col("_notes").alias("notes"), F.col("_flags").alias("flags"))
    return conform(out, "measurements")


def measurements_of_type(measurements: DataFrame, requested_type: str) -> DataFrame:
    """Measurements of one subtype with its typed column as ``result``."""
    column = {"continuous": "result_double", "discrete": "result_string", "complex": "result_array"}
    if requested_type not in column:
        raise ValueError(f"unknown measurement type {requested_type!r}; known: {RESULT_TYPES}")
    others = [c for c in column.values() if c != column[requested_type]]
    return (measurements.where(F.col("result_type") == requested_type)
            .drop(*others).withColumnRenamed(column[requested_type], "result"))


def build_critical_care(df: DataFrame, id_column: str, admission_datetime: str | Sequence[str] | None = None,
                        discharge_datetime: str | Sequence[str] | None = None,
                        request_location: str | None = None, icu_days: str | None = None,
                        ventilated: str | None = None, covid_status: str | None = None,
                        patients: DataFrame | None = None, keep_extra: bool = False) -> DataFrame:
    """Stay rows → ``critical_care`` (X4).  Unreadable dates become null; ICU days that are not a number fail the load.

    With ``keep_extra`` the columns not used go to ``extra`` (dynamic attributes).
    """
    if patients is not None:
        assert_parents(df, patients, id_column)

    def parse(frame, value, prefix):
        if value is None:
            return (frame.withColumn(f"{prefix}_date", F.lit(None).cast("date"))
                    .withColumn(f"{prefix}_time", F.lit(None).cast("double")))
        text = join_datetime([value] if isinstance(value, str) else list(value))
        return with_parsed_datetime(frame.withColumn(f"{prefix}_text", text), f"{prefix}_text",
                                    f"{prefix}_date", f"{prefix}_time")

    df = parse(parse(df, admission_datetime, "__wl_adm"), discharge_datetime, "__wl_dis")

    def opt(c, cast="string"):
        return ref(c).cast("string").try_cast(cast) if c else F.lit(None).cast(cast)

    used = {id_column, request_location, icu_days, ventilated, covid_status}
    for value in (admission_datetime, discharge_datetime):
        used.update([value] if isinstance(value, str) else list(value or []))
    pid = canonical_id(ref(id_column))
    days = F.lit(None).cast("double")
    if icu_days:
        bad = F.raise_error(F.concat(F.lit("ICU days are not a number for patient "), F.coalesce(pid, F.lit("?")), F.lit(": "), ref(icu_days).cast("string")))
        unread = ref(icu_days).isNotNull() & (F.trim(ref(icu_days).cast("string")) != "") & number(ref(icu_days)).isNull()
        days = F.when(unread, bad.cast("double")).otherwise(number(ref(icu_days)))
    extra = _extra(df, used) if keep_extra else F.lit(None).cast("map<string,string>")
    out = df.select(canonical_id(ref(id_column)).alias("patient_id"), extra.alias("extra"),
                    F.col("__wl_adm_date").alias("admission_date"), F.col("__wl_adm_time").alias("admission_time"),
                    F.col("__wl_dis_date").alias("discharge_date"), F.col("__wl_dis_time").alias("discharge_time"),
                    opt(request_location).alias("request_location"), days.alias("icu_days"),
                    F.trim(opt(ventilated)).alias("ventilated"), F.trim(opt(covid_status)).alias("covid_status"))
    return conform(out, "critical_care")


def build_comorbidities(df: DataFrame, id_column: str, exclude_columns: Sequence[str] | None = None,
                        conflicts: str = "ignore", edit_threshold: int = 2,
                        existing_keys: DataFrame | None = None, policy: str = "tabular",
                        patients: DataFrame | None = None, order: str = "header"
                        ) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """One-hot condition columns → links and dictionary keys (X7 = R1 + Z1).

    Returns ``(links, new_keys, decisions)``: ``links`` is (patient_id,
    comorb_name) with names resolved to dictionary keys, ``new_keys`` the keys
    to add, ``decisions`` one row per distinct name.  Returns ``None`` (with a
    warning) when no flag is positive.  New names enter the dictionary in
    ``order``: ``"header"`` (the column order, as the names first appear) or
    ``"name"`` (alphabetical).
    """
    if order not in ("header", "name"):
        raise ValueError("order must be 'header' or 'name'")
    if patients is not None:
        assert_parents(df, patients, id_column)
    wide = drop_columns(df.drop(FILE_COL), exclude_columns)
    flags = [c for c in wide.columns if c != id_column]
    # One aggregate per flag column gives the names in use; no row is shuffled for it.
    positive = value_key(F.lit("1"))
    used = wide.agg(*[F.max((value_key(ref(c)) == positive).cast("int")).alias(str(i)) for i, c in enumerate(flags)]).first() if flags else []
    found = [(c, i) for i, c in enumerate(flags) if used[i] == 1]
    if not found:
        warn("No condition is positive in any row; nothing was added")
        return None
    links = melt_onehot(wide.select(ref(id_column), *[ref(c) for c, _ in found]), id_column)
    names = df.sparkSession.createDataFrame(found, "name string, _ord long")   # at most one row per column
    order_col = "_ord" if order == "header" else None
    decisions = resolve_names(names, edit_threshold, existing=existing_keys, conflicts=conflicts, policy=policy,
                              order_col=order_col)
    # Names are column headers, so ``decisions`` has at most one row per flag
    # column: a proven bound.  Broadcasting it keeps a condition shared by a
    # third of all patients from landing in one shuffle partition.
    mapping = F.broadcast(decisions.select(F.col("name").alias("comorb_name"), "comorb_key"))
    mapped = (links.join(mapping, "comorb_name")
              .where(F.col("comorb_key").isNotNull())
              .select("patient_id", F.col("comorb_key").alias("comorb_name")).distinct())
    new_keys = decisions.where(F.col("action") == "new_key").select(F.col("name").alias("comorb_name"))
    return mapped, new_keys, decisions
