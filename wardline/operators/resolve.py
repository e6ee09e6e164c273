"""Per-entity value resolution over many sources.

Plan shape, for any mix of variables:

1. each source projects to one narrow row per input row with a fixed schema
   (id, file, per-variable min/max comparison keys and 0/1 flags);
2. the projections are unioned (no shuffle) and grouped by ``(id, file)`` --
   partial aggregation on the map side, so a hot entity costs one row per
   file per map task;
3. a second ``groupBy(id)`` with conditional aggregates applies the conflict
   policy across files (again partially aggregated).

Entities whose every file conflicts still come out of step 3 (with a null
value), because conflicting groups are kept and only masked.  No join to an
entity spine is needed: every id seen in any source is a group.  min/max of
text keys replace ``countDistinct`` so nothing is collected per entity.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.functions.labels import contains_ci, regex_any, value_key
from wardline.operators.columns import match_columns
from wardline.sources.model import FILE_COL, Source, SourceSet


@dataclass(frozen=True)
class Single:
    """One value expected per entity (A4): columns found by ``patterns``."""
    patterns: tuple[str, ...]


@dataclass(frozen=True)
class Classes:
    """Values classified by patterns (A8 input): 1 per class if any value matches."""
    patterns: tuple[str, ...]
    classes: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class AnyMatch:
    """1 when a row of a keyword file has ``column`` matching a pattern."""
    file_keyword: str
    column: str
    patterns: tuple[str, ...]


@dataclass(frozen=True)
class Presence:
    """1 when the entity has a row in a keyword file (A7 presence mode)."""
    file_keyword: str


@dataclass(frozen=True)
class ValueEquals:
    """1 when a row of a keyword file has ``column`` equal to ``value`` (A7 value mode)."""
    file_keyword: str
    column: str
    value: str


def single(*patterns: str) -> Single:
    return Single(tuple(patterns))


def classes(patterns, **by_class) -> Classes:
    return Classes(tuple(patterns), tuple((k, tuple(v)) for k, v in by_class.items()))


def _least(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.least(*cols)


def _greatest(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def _null_s() -> Column:
    return F.lit(None).cast("string")


def _null_i() -> Column:
    return F.lit(None).cast("int")


def _row_projection(src: Source, variables: dict) -> DataFrame:
    """Step 1: one narrow row per input row with the fixed per-variable schema."""
    out = [ref(src.id_column).alias("_id"), ref(FILE_COL)]
    in_file = {}
    for name, spec in variables.items():
        if isinstance(spec, Single):
            keys = [value_key(ref(c)) for c in match_columns(src.columns, spec.patterns)]
            out += [(_least(keys) if keys else _null_s()).alias(f"{name}__kmin"),
                    (_greatest(keys) if keys else _null_s()).alias(f"{name}__kmax")]
        elif isinstance(spec, Classes):
            cols = match_columns(src.columns, spec.patterns)
            for cls, pats in spec.classes:
                hits = [regex_any(ref(c), pats).cast("int") for c in cols]
                out.append((_greatest(hits) if hits else _null_i()).alias(f"{name}__{cls}"))
        else:
            kw = spec.file_keyword
            if kw not in in_file:
                in_file[kw] = contains_ci(FILE_COL, kw)
            if isinstance(spec, Presence):
                flag = F.when(in_file[kw], F.lit(1))
            elif spec.column not in src.columns:
                flag = _null_i()
            elif isinstance(spec, AnyMatch):
                flag = F.when(in_file[kw], regex_any(ref(spec.column), spec.patterns).cast("int"))
            else:
                flag = F.when(in_file[kw] & (value_key(ref(spec.column)) == value_key(F.lit(spec.value))),
                              F.lit(1))
            out.append(flag.cast("int").alias(name))
    return src.df.select(*out)


def entity_aggregates(sources: SourceSet, variables: dict, conflicts: str = "ignore",
                      id_alias: str | None = None) -> DataFrame:
    """Resolve every variable for every entity in one two-level aggregation.

    Output columns, per variable kind:

    * ``Single``: ``<v>`` the agreed comparison key or null, ``<v>__file_conflicts``
      (files dropped for holding more than one value) and ``<v>__entity_conflict``
      (surviving files disagree).  With ``conflicts='raise'`` reading ``<v>``
      fails the job on the first conflicting entity.
    * ``Classes``: ``<v>__<class>`` in {0, 1}.
    * flags (``AnyMatch``, ``Presence``, ``ValueEquals``): ``<v>`` in {0, 1}.
    """
    if conflicts not in ("ignore", "raise"):
        raise ValueError("conflicts must be 'raise' or 'ignore'")
    if not len(sources):
        raise ValueError("no sources")
    return decide_states(file_states(sources, variables), variables, conflicts, id_alias or sources.id_column)


def file_states(sources: SourceSet | list[Source], variables: dict) -> DataFrame:
    """Step 2: per (``_id``, ``_file``) the least and greatest key of each ``Single``, class flags and flags.

    States of the same group merge by ``merge_states``, so they can be kept and
    extended as more files arrive.
    """
    rows = reduce(lambda a, b: a.unionByName(b), [_row_projection(s, variables) for s in sources])
    return merge_states(rows.where(F.col("_id").isNotNull()), variables)      # a row without an id belongs to no entity


def merge_states(states: DataFrame, variables: dict) -> DataFrame:
    """One state per (``_id``, ``_file``): minima, maxima and flags combine in any order and any number of times."""
    aggs = []
    for name, spec in variables.items():
        if isinstance(spec, Single):
            aggs += [F.min(f"{name}__kmin").alias(f"{name}__kmin"), F.max(f"{name}__kmax").alias(f"{name}__kmax")]
        elif isinstance(spec, Classes):
            aggs += [F.max(f"{name}__{cls}").alias(f"{name}__{cls}") for cls, _ in spec.classes]
        else:
            aggs.append(F.max(name).alias(name))
    return states.groupBy(F.col("_id"), ref(FILE_COL)).agg(*aggs)


def decide_states(per_file: DataFrame, variables: dict, conflicts: str = "ignore", id_alias: str = "patient_id") -> DataFrame:
    """Step 3: the decision per entity from the states of all its files (see ``entity_aggregates``)."""
    aggs2 = []
    for name, spec in variables.items():
        if isinstance(spec, Single):
            lo, hi = F.col(f"{name}__kmin"), F.col(f"{name}__kmax")
            clean = lo == hi
            aggs2 += [F.min(F.when(clean, lo)).alias(f"{name}__lo"),
                      F.max(F.when(clean, hi)).alias(f"{name}__hi"),
                      F.sum(F.when(lo != hi, 1).otherwise(0)).cast("long").alias(f"{name}__file_conflicts")]
        elif isinstance(spec, Classes):
            aggs2 += [F.coalesce(F.max(f"{name}__{cls}"), F.lit(0)).alias(f"{name}__{cls}")
                      for cls, _ in spec.classes]
        else:
            aggs2.append(F.coalesce(F.max(name), F.lit(0)).alias(name))
    per_entity = per_file.groupBy("_id").agg(*aggs2)

    final = [F.col("_id").alias(id_alias)]
    for name, spec in variables.items():
        if isinstance(spec, Single):
            lo, hi = F.col(f"{name}__lo"), F.col(f"{name}__hi")
            n_file = F.col(f"{name}__file_conflicts")
            entity_conflict = F.coalesce(lo != hi, F.lit(False))
            value = F.when(lo == hi, lo)
            if conflicts == "raise":
                msg = F.concat(F.lit(f"Conflicting {name} values found for patient "), F.col("_id"),
                               F.when(n_file > 0, F.lit(" within a file")).otherwise(F.lit(" across files")))
                value = F.when((n_file > 0) | entity_conflict, F.raise_error(msg).cast("string")).otherwise(value)
            final += [value.alias(name), n_file.alias(f"{name}__file_conflicts"),
                      entity_conflict.alias(f"{name}__entity_conflict")]
        elif isinstance(spec, Classes):
            final += [F.col(f"{name}__{cls}") for cls, _ in spec.classes]
        else:
            final.append(ref(name))
    return per_entity.select(*final)


def tri_state(pos: Column, neg: Column, susp: Column, suspected_blocks_negative: bool = True) -> Column:
    """P if any positive; N if any negative (and no suspected, by default); else U."""
    negative = (neg == 1) & (susp == 0) if suspected_blocks_negative else (neg == 1)
    return F.when(pos == 1, F.lit("P")).when(negative, F.lit("N")).otherwise(F.lit("U"))


def entity_spine(sources: SourceSet, id_alias: str | None = None) -> DataFrame:
    """Distinct entity ids over all sources (A1)."""
    frames = [s.df.select(ref(s.id_column).alias(id_alias or sources.id_column)) for s in sources]
    return reduce(lambda a, b: a.unionByName(b), frames).where(ref(id_alias or sources.id_column).isNotNull()).distinct()


def entity_index(sources: SourceSet, id_alias: str | None = None) -> DataFrame:
    """Rows per (entity, file) (A2): the inverted index, as a table."""
    idc = id_alias or sources.id_column
    frames = [s.df.select(ref(s.id_column).alias(idc), ref(FILE_COL)) for s in sources]
    return (reduce(lambda a, b: a.unionByName(b), frames)
            .where(ref(idc).isNotNull())
            .groupBy(idc, FILE_COL).agg(F.count(F.lit(1)).alias("n_rows")))


def _long_values(sources: SourceSet, patterns, name: str = "value", keyed: bool = False) -> DataFrame:
    """(id, file, value) for every matched column of every source.

    Null values are kept (callers decide); rows without an id are not.
    """
    frames = []
    for s in sources:
        cols = match_columns(s.columns, patterns)
        base = s.df.select(ref(s.id_column).alias("_id"), ref(FILE_COL),
                           *[ref(c).cast("string").alias(c) for c in cols])
        if not cols:
            frames.append(base.select("_id", FILE_COL, _null_s().alias(name)))
            continue
        long = base.unpivot(["_id", FILE_COL], [ref(c) for c in cols], "_column", name).drop("_column")
        if keyed:
            long = long.withColumn(name, value_key(ref(name)))
        frames.append(long)
    return reduce(lambda a, b: a.unionByName(b), frames).where(F.col("_id").isNotNull())


def multi_values(sources: SourceSet, patterns, id_alias: str | None = None, value_name: str = "value") -> DataFrame:
    """Distinct values per entity over all matched columns and files (A3), long form.

    One row per (entity, distinct value); an entity with no value gets one
    row with a null value.  Long form keeps a hot entity spread over tasks.
    """
    idc = id_alias or sources.id_column
    rows = _long_values(sources, patterns, value_name).withColumn(value_name, F.trim(ref(value_name)))
    rows = rows.withColumn(value_name, F.when(ref(value_name) == "", _null_s()).otherwise(ref(value_name)))
    values = rows.where(ref(value_name).isNotNull()).select(F.col("_id").alias(idc), value_name).distinct()
    empties = (rows.groupBy("_id").agg(F.max(ref(value_name).isNotNull()).alias("_has"))
               .where(~F.col("_has")).select(F.col("_id").alias(idc), _null_s().alias(value_name)))
    return values.unionByName(empties)


def conflict_report(sources: SourceSet, variables: dict[str, Single], id_alias: str | None = None) -> DataFrame:
    """Every value involved in a conflict (A5), long form.

    ``level='file'``: the entity holds more than one value inside one file;
    ``level='entity'``: files that are clean on their own disagree.
    Columns: id, level, _file, variable, value.

    The least and the greatest value of each (entity, variable, file) come
    from one partially aggregated ``groupBy`` over the scan; only rows of
    groups that disagree are then kept (semi join) and made distinct.  No
    window or list holds an entity's values, nothing is written on the way.
    """
    idc = id_alias or sources.id_column
    frames = []
    for name, spec in variables.items():
        frames.append(_long_values(sources, spec.patterns, "value", keyed=True)
                      .where(F.col("value").isNotNull()).withColumn("variable", F.lit(name)))
    rows = reduce(lambda a, b: a.unionByName(b), frames).select("_id", "variable", FILE_COL, "value")
    per_file = rows.groupBy("_id", "variable", FILE_COL).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    mixed = per_file.where("_lo <> _hi").select("_id", "variable", FILE_COL)
    file_level = rows.join(mixed, ["_id", "variable", FILE_COL], "left_semi").distinct().withColumn("level", F.lit("file"))
    clean = per_file.where("_lo = _hi").select("_id", "variable", FILE_COL, F.col("_lo").alias("value"))
    disagree = (clean.groupBy("_id", "variable").agg(F.min("value").alias("_a"), F.max("value").alias("_b"))
                .where(F.col("_a") != F.col("_b")).select("_id", "variable"))
    entity_level = clean.join(disagree, ["_id", "variable"], "left_semi").withColumn("level", F.lit("entity"))
    cols = [F.col("_id").alias(idc), "level", FILE_COL, "variable", "value"]
    return file_level.select(*cols).unionByName(entity_level.select(*cols))


def gather_values(sources: SourceSet, patterns, id_alias: str | None = None) -> DataFrame:
    """Distinct values per (entity, file) (A11): a value in two files counts twice.

    A file with more than one matching column is an error, as in the rewrite
    step that follows.
    """
    for s in sources:
        if len(match_columns(s.columns, patterns)) > 1:
            raise ValueError(f"Multiple value columns found {match_columns(s.columns, patterns)}")
    idc = id_alias or sources.id_column
    return (_long_values(sources, patterns, "value")
            .where(F.col("value").isNotNull())
            .select(F.col("_id").alias(idc), FILE_COL, "value").distinct())
