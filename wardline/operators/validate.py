"""Validation as DataFrames of offending rows, plus eager assertions.

Each check returns the offending rows lazily; ``assert_none`` runs one action
with a ``limit`` and raises ``ValueError`` listing a sample, so a check costs
one pass that stops early on failure.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.labels import number
from wardline.functions.refs import ref


def invalid_choices(df: DataFrame, column: str, choices: Iterable) -> DataFrame:
    """Rows whose non-null ``column`` is outside ``choices``."""
    return df.where(ref(column).isNotNull() & ~ref(column).isin(list(choices)))


def missing_required(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with a null in any required column (P10)."""
    cond = None
    for c in columns:
        cond = ref(c).isNull() if cond is None else (cond | ref(c).isNull())
    return df.where(cond) if cond is not None else df.limit(0)


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, with their count.

    ``count`` is partially aggregated, so a hot key costs one row per map task.
    """
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def missing_parents(facts: DataFrame, parents: DataFrame, fact_id: str, parent_id: str | None = None,
                    id_alias: str = "patient_id", registered: bool = False) -> DataFrame:
    """Fact ids with no parent row (J2), with the number of fact rows each.

    Only the id column of the facts is read; the count is partially
    aggregated before the anti join, so the join sees one row per id.
    ``registered`` says that the parents' ids are canonical text, as those of a
    registry are: they are compared as stored, and bucketed parents stay in place.
    """
    parent_id = parent_id or fact_id
    ids = (facts.select(F.trim(ref(fact_id).cast("string")).alias(id_alias))
           .groupBy(id_alias).agg(F.count(F.lit(1)).alias("n_rows")))
    known = parents.select((ref(parent_id) if registered else F.trim(ref(parent_id).cast("string"))).alias(id_alias))
    return ids.join(known, id_alias, "left_anti")


def unreadable_numbers(df: DataFrame, id_column: str, columns: Iterable[str], id_alias: str = "patient_id") -> DataFrame:
    """(id, column, value): non-null cells of ``columns`` that are not numbers, a row each."""
    columns = list(columns)
    narrow = df.select(ref(id_column).cast("string").alias(id_alias), *[ref(c).cast("string").alias(c) for c in columns])
    cells = narrow.unpivot([ref(id_alias)], [ref(c) for c in columns], "column", "value")
    return cells.where(F.col("value").isNotNull() & (F.trim("value") != "") & number("value").isNull())


def assert_none(offending: DataFrame, message: str, sample: int = 20) -> None:
    """Raise ``ValueError(message + sample)`` when ``offending`` has any row."""
    rows = offending.limit(sample).collect()
    if rows:
        listed = "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows)
        raise ValueError(f"{message}: {listed}")


def assert_parents(facts: DataFrame, parents: DataFrame, fact_id: str, parent_id: str = "patient_id") -> None:
    """Every fact id must already be a registered entity (J2); registered ids are canonical text."""
    text = parents.schema[parent_id].dataType.typeName() == "string"
    assert_none(missing_parents(facts, parents, fact_id, parent_id, registered=text).select("patient_id"),
                "These ids are not registered patients; add the patients first")


def guard_rows(df: DataFrame, table: str) -> DataFrame:
    """Wrap columns so a null required value or a value outside its choices fails the job.

    The checks run in the same projection that feeds the write: no extra pass.
    """
    from wardline.schemas import CHOICES, REQUIRED

    required = set(REQUIRED.get(table, ()))
    choices = CHOICES.get(table, {})
    cols = []
    for name in df.columns:
        c = ref(name)
        if name in required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"Missing required {name} in {table}")).cast(
                df.schema[name].dataType)).otherwise(c)
        if name in choices:
            bad = ref(name).isNotNull() & ~ref(name).isin(list(choices[name]))
            c = F.when(bad, F.raise_error(F.concat(F.lit(f"Invalid {name} in {table}: "),
                                                   ref(name).cast("string"))).cast(df.schema[name].dataType)
                       ).otherwise(c)
        cols.append(c.alias(name))
    return df.select(*cols)
