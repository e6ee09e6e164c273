"""Reject routing (P9, P10, F8): all row checks in one pass, accepted and rejected rows in one write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardline.functions.labels import number
from wardline.functions.refs import ref
from wardline.schemas import CHOICES, REQUIRED


def reasons(checks: Mapping[str, Column]) -> Column:
    """The names of the checks that fail a row, in the order given; a check that is null does not fail it."""
    if not checks:
        return F.array().cast("array<string>")
    named = [F.when(condition, F.lit(name)) for name, condition in checks.items()]
    return F.filter(F.array(*named), lambda r: r.isNotNull())


def table_checks(table: str, columns) -> dict[str, Column]:
    """The checks of a registry table on those of its ``columns`` that are there: required values, then allowed ones."""
    checks = {f"missing {c}": ref(c).isNull() for c in REQUIRED.get(table, ()) if c in columns}
    for c, allowed in CHOICES.get(table, {}).items():
        if c in columns:
            checks[f"invalid {c}"] = ref(c).isNotNull() & ~ref(c).isin(list(allowed))
    return checks


def not_a_number(column: str) -> Column:
    """True for text that is there and no number."""
    text = F.trim(ref(column).cast("string"))
    return (text != "") & number(text).isNull()


def route_rows(df: DataFrame, checks: Mapping[str, Column], path: str, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write ``df`` to ``path``, split by ``checks``; returns (accepted, rejected, counts).

    A check is a condition under which a row is refused.  Every row is read and
    checked once, and goes to the folder ``rejected=false`` or
    ``rejected=true``; rejected rows carry their ``reasons``.  ``counts`` has
    the rows of each part, and of each check, counted while they are written.
    A retried task counts once more in ``Observation`` only if its first try
    had succeeded; the parts themselves hold every row once.
    """
    taken = {"reasons", "rejected"} & set(df.columns)
    if taken:
        raise ValueError(f"columns of these names are added here: {sorted(taken)}")
    routed = df.withColumn("reasons", reasons(checks)).withColumn("rejected", F.size("reasons") > 0)
    seen = Observation()
    names = list(checks)
    counts = [F.count_if("rejected").alias("rejected"), F.count_if(~F.col("rejected")).alias("accepted")]
    counts += [F.count_if(F.array_contains("reasons", n)).alias(f"check_{i}") for i, n in enumerate(names)]
    routed.observe(seen, *counts).write.mode(mode).partitionBy("rejected").parquet(path)
    got = seen.get
    stored = df.sparkSession.read.schema(routed.schema).parquet(path)
    accepted = stored.where("not rejected").drop("reasons", "rejected")
    rejected = stored.where("rejected").drop("rejected")
    return accepted, rejected, {"accepted": got["accepted"], "rejected": got["rejected"], **{n: got[f"check_{i}"] for i, n in enumerate(names)}}
