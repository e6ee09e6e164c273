"""Upsert with history (K3 with updates, P8): field-wise merge, validity intervals, reads as of a time.

A load brings at most one row per key.  A value that is not null (nor one of
the column's words for "unknown") replaces the stored one, everything else
stays.  Only rows that change are written, whole, into the folder of their load
(``<root>/load=N``, with the load's time), so a version of a row is valid from
its load until the next load that wrote the key.  Reading as of a time takes the
newest version not after it; later loads are pruned by folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.refs import ref
from wardline.operators.validate import assert_none

_OWN = ("valid_from", "valid_to", "change", "load")


class HistoryTable:
    """Versions of the rows of one table, keyed by ``key``.

    ``schema`` holds the key and the fields; ``unknown`` maps a field to the
    values that say nothing (a default such as ``U``), which never replace a
    known value.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, key: str = "patient_id",
                 unknown: Mapping[str, Sequence] | None = None):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.fields = [f.name for f in self.schema.fields if f.name != key]
        if key not in self.schema.names or set(_OWN) & set(self.schema.names):
            raise ValueError(f"the schema needs the key {key!r} and none of the names {', '.join(_OWN)}")
        self.unknown = {k: list(v) for k, v in (unknown or {}).items()}
        if set(self.unknown) - set(self.fields):
            raise ValueError(f"no such fields: {sorted(set(self.unknown) - set(self.fields))}")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- loads --------------------------------------------------------------
    def loads(self) -> list[tuple[int, dt.datetime]]:
        """(number, time) of every load that was finished; times rise with the numbers."""
        base = self._Path(self.root)
        if not self._fs.exists(base):
            return []
        found = []
        for st in self._fs.listStatus(base):
            name = st.getPath().getName()
            if name.startswith("load=") and self._fs.exists(self._Path(st.getPath(), "_SUCCESS")):
                number, _, stamp = name[len("load="):].partition("-at-")
                found.append((int(number), dt.datetime.strptime(stamp, "%Y%m%d%H%M%S%f")))
        return sorted(found)

    def _folder(self, number: int, at: dt.datetime) -> str:
        return f"{self.root}/load={number}-at-{at:%Y%m%d%H%M%S%f}"

    def _versions(self, until: dt.datetime | None = None) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("valid_from", T.TimestampNTZType()),
                               T.StructField("change", T.StringType()), T.StructField("load", T.LongType())])
        folders = [self._folder(n, at) for n, at in self.loads() if until is None or at <= until]
        return self.spark.read.schema(stored).parquet(*folders) if folders else self.spark.createDataFrame([], stored)

    def _newest(self, until: dt.datetime | None = None) -> DataFrame:
        """The newest version of every key that is not deleted; aggregated, no window."""
        names = [*self.fields, "change", "valid_from"]
        newest = self._versions(until).groupBy(ref(self.key)).agg(F.max_by(F.struct(*[ref(n) for n in names]), "load").alias("_row"))
        rows = newest.select(ref(self.key), *[F.col("_row")[n].alias(n) for n in names])
        return rows.where("change <> 'delete'").drop("change")

    def _start(self, at: dt.datetime) -> int:
        """The number of a load at ``at``; loads go forward in time."""
        if at.tzinfo is not None:
            raise ValueError("load times carry no time zone: give them in one zone throughout")
        done = self.loads()
        if done and at <= done[-1][1]:
            raise ValueError(f"a load at {at} must come after the last one, at {done[-1][1]}")
        return done[-1][0] + 1 if done else 1

    def _write(self, rows: DataFrame, number: int, at: dt.datetime) -> DataFrame:
        rows = rows.withColumns({"valid_from": F.lit(at).cast("timestamp_ntz"), "load": F.lit(number).cast("long")})
        path = self._folder(number, at)
        rows.select(ref(self.key), *[ref(f) for f in self.fields], "valid_from", "change", "load").write.mode("overwrite").parquet(path)
        return self._versions(at).where(F.col("load") == number).drop("load")

    def upsert(self, rows: DataFrame, at: dt.datetime) -> DataFrame:
        """Merge ``rows`` at time ``at``; returns the versions written, with ``change`` (``insert`` or ``update``).

        Missing columns count as null, extra ones are an error, as is a key that
        comes twice or is null.  A key that was deleted is inserted afresh: its
        old values do not come back.  One check, one join against the newest
        versions of the keys, one write; a load that died on the way does not
        count, and the next one may have its number.
        """
        extra = set(rows.columns) - set(self.schema.names)
        if extra:
            raise ValueError(f"columns that the table does not have: {sorted(extra)}")
        number = self._start(at)
        given = rows.select(*[(ref(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        per_key = given.groupBy(ref(self.key)).agg(F.count(F.lit(1)).alias("n_rows"))
        assert_none(per_key.where((F.col("n_rows") > 1) | ref(self.key).isNull()), f"Keys missing or repeated in one load ({self.key})")
        new = given.select(ref(self.key), *[self._known(f).alias(f"_new_{f}") for f in self.fields], *[ref(f).alias(f"_raw_{f}") for f in self.fields])
        old = self._newest().select(ref(self.key).alias("_old_key"), *[ref(f).alias(f"_old_{f}") for f in self.fields])
        both = new.join(old, ref(self.key) == F.col("_old_key"), "left")
        fresh = F.col("_old_key").isNull()
        # An unknown word is kept where nothing is stored: it is the column's default.
        merged = {f: F.coalesce(ref(f"_new_{f}"), ref(f"_old_{f}"), ref(f"_raw_{f}")) for f in self.fields}
        differs = fresh
        for f in self.fields:
            differs = differs | ~merged[f].eqNullSafe(ref(f"_old_{f}"))
        changed = both.where(differs).select(ref(self.key), *[c.alias(f) for f, c in merged.items()],
                                             F.when(fresh, "insert").otherwise("update").alias("change"))
        return self._write(changed, number, at)

    def _known(self, field: str) -> Column:
        words = self.unknown.get(field)
        return F.when(~ref(field).isin(words), ref(field)) if words else ref(field)

    def delete(self, ids: DataFrame, at: dt.datetime, id_column: str | None = None) -> DataFrame:
        """End the validity of the keys in ``ids`` at time ``at``; keys that are not stored are passed over."""
        number = self._start(at)
        doomed = ids.select(ref(id_column or self.key).cast(self.schema[self.key].dataType).alias(self.key)).distinct()
        gone = self._newest().join(doomed, self.key, "left_semi").withColumn("change", F.lit("delete"))
        return self._write(gone.drop("valid_from"), number, at)

    # -- reads --------------------------------------------------------------
    def current(self) -> DataFrame:
        """The newest version of every key that is not deleted, and since when it is valid."""
        return self._newest()

    def as_of(self, at: dt.datetime) -> DataFrame:
        """The rows that were valid at time ``at``, and since when."""
        return self._newest(at)

    def history(self) -> DataFrame:
        """Every version with the interval it was valid in: from ``valid_from`` until before ``valid_to`` (null: still valid).

        The window holds the versions of one key, of which there is at most one per load.
        """
        order = W.partitionBy(ref(self.key)).orderBy("load")
        rows = self._versions().withColumn("valid_to", F.lead("valid_from").over(order))
        return rows.where("change <> 'delete'").select(ref(self.key), *[ref(f) for f in self.fields], "valid_from", "valid_to")
