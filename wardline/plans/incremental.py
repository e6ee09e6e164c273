"""Incremental entity resolution (A4, A5, A8, A12 over repeated loads).

A decision about an entity needs only the state of each of its files: the least
and the greatest key of every variable, and flags.  ``ResolvedStore`` keeps those
states.  A drop of new files is scanned once, its states are appended, and just
the entities that it touches are decided again from the states of all their
files; files of earlier drops are never read again.  Every drop leaves a change
set: the rows of entities that are new or decided differently.

Layout, below one shared folder: ``states/drop=N/bucket=B`` (one row per entity
and file), ``decided/drop=N/bucket=B`` (the change set) and ``files/drop=N`` (the
names of the files, where they are known).  Buckets are a hash of the id, so a
drop reads only those that hold its entities.  A drop counts once its
``decided`` folder has a ``_SUCCESS`` marker; until then a retry under the same
number replaces what was left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.operators.resolve import Classes, Single, decide_states, file_states, merge_states
from wardline.sources.model import FILE_COL, SourceSet


class ResolvedStore:
    """Decisions about entities, kept up to date drop by drop.

    ``variables`` are those of ``entity_aggregates``; ``finish`` maps their
    decisions to the rows that are kept (default: the decisions themselves).
    The number of ``buckets`` and the variables are fixed when the folder is
    first used.  ``conflicts="raise"`` fails the drop that brings a conflict.
    """

    def __init__(self, spark: SparkSession, root: str, variables: dict, finish: Callable[[DataFrame], DataFrame] | None = None,
                 conflicts: str = "ignore", id_alias: str = "patient_id", buckets: int = 64):
        if conflicts not in ("ignore", "raise"):
            raise ValueError("conflicts must be 'raise' or 'ignore'")
        self.spark, self.root, self.variables = spark, root.rstrip("/"), variables
        self.finish, self.conflicts, self.id_alias = finish, conflicts, id_alias
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.buckets = self._fixed(buckets)

    def _fixed(self, buckets: int) -> int:
        """The number of buckets the folder was made with; other variables than then are refused."""
        path, spec = f"{self.root}/spec", repr(sorted(self.variables.items()))
        if not self._fs.exists(self._Path(f"{path}/_SUCCESS")):
            rows = [(int(buckets), spec, self.id_alias)]
            self.spark.createDataFrame(rows, "buckets int, variables string, id_alias string").coalesce(1).write.mode("overwrite").json(path)
            return int(buckets)
        made = self.spark.read.schema("buckets int, variables string, id_alias string").json(path).first()
        if (made["variables"], made["id_alias"]) != (spec, self.id_alias):
            raise ValueError(f"{self.root} was made for other variables: {made['variables']}")
        return made["buckets"]

    # -- drops --------------------------------------------------------------
    def _listed(self, path: str, prefix: str) -> list[int]:
        base = self._Path(path)
        if not self._fs.exists(base):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(base) if st.isDirectory()]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def drops(self) -> list[int]:
        """Numbers of the drops that count."""
        return [n for n in self._listed(f"{self.root}/decided", "drop=") if self._fs.exists(self._Path(f"{self.root}/decided/drop={n}/_SUCCESS"))]

    def _folders(self, kind: str, drops: list[int]) -> list[str]:
        """Folders of ``kind`` that hold the drops since the last compaction."""
        full = self._listed(f"{self.root}/compacted", "drop=")
        first = max((n for n in full if n in drops), default=0)
        return [f"{self.root}/{kind}/drop={n}" for n in drops if n >= first]

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def _read(self, kind: str, schema, drops: list[int]) -> DataFrame:
        folders = self._folders(kind, drops)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*folders)

    def loaded_files(self) -> set[str]:
        """Names of the files in the drops that count, as far as their sources listed them."""
        folders = [f"{self.root}/files/drop={n}" for n in self.drops()]
        folders = [f for f in folders if self._fs.exists(self._Path(f))]
        return {r["name"] for r in self.spark.read.schema("name string").json(folders).collect()} if folders else set()

    def add(self, sources: SourceSet, drop: int | None = None) -> DataFrame:
        """Load the files of ``sources`` as one drop; returns its change set.

        A file that an earlier drop loaded is refused: its rows would be read
        again for nothing.
        """
        names = sorted({f for s in sources for f in s.files or ()})
        again = self.loaded_files() & set(names) if drop is None or drop not in self.drops() else set()
        if again:
            raise ValueError(f"files loaded before: {', '.join(sorted(again))}")
        drop = drop if drop is not None else max(self.drops(), default=0) + 1
        if names:
            self.spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("overwrite").json(f"{self.root}/files/drop={drop}")
        return self.add_states(file_states(sources, self.variables), drop)

    def add_states(self, states: DataFrame, drop: int) -> DataFrame:
        """Append ``states`` (as of ``file_states``) as drop ``drop`` and decide the entities they touch.

        A drop that counts already is left as it is and its change set is
        returned, so a repeated call, as of a stream that restarts, changes nothing.
        """
        path = f"{self.root}/states/drop={drop}"
        if drop in self.drops():
            return self.changes(drop)
        states.withColumn("bucket", self._bucket("_id")).write.mode("overwrite").partitionBy("bucket").parquet(path)
        touched = self._listed(path, "bucket=")
        schema = self._state_schema(states)
        earlier = [n for n in self.drops() if n < drop]
        near = F.col("bucket").isin(touched)             # prunes folders: the other buckets are not listed into the scan
        new = self._read("states", schema, [drop]) if touched else self.spark.createDataFrame([], schema)
        ids = new.select("_id").distinct()
        old = self._read("states", schema, earlier).where(near).join(ids, "_id", "left_semi")
        merged = merge_states(new.unionByName(old), self.variables)
        decided = decide_states(merged, self.variables, self.conflicts, self.id_alias)
        decided = self.finish(decided) if self.finish else decided
        columns = [c for c in decided.columns if c != self.id_alias]
        before = self._latest(earlier, decided, near).select(
            ref(self.id_alias).alias("_before_id"), F.struct(*[ref(c) for c in columns]).alias("_before"))
        same = F.struct(*[ref(c) for c in columns]).eqNullSafe(F.col("_before"))
        changed = (decided.join(before, ref(self.id_alias) == F.col("_before_id"), "left")
                   .where(F.col("_before_id").isNull() | ~same)
                   .withColumn("change", F.when(F.col("_before_id").isNull(), "insert").otherwise("update"))
                   .drop("_before_id", "_before"))
        (changed.withColumn("bucket", self._bucket(self.id_alias))
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/decided/drop={drop}"))
        return self.changes(drop)

    def _state_schema(self, states: DataFrame):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in states.schema.fields if f.name not in ("bucket", "drop"))
        return f"{fields}, drop int, bucket int"

    def _decided_schema(self, decided: DataFrame):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in decided.schema.fields if f.name not in ("change", "bucket", "drop"))
        return f"{fields}, change string, drop int, bucket int"

    def _shape(self) -> DataFrame:
        """An empty frame with the columns of the decisions."""
        decided = decide_states(empty_states(self.spark, self.variables), self.variables, "ignore", self.id_alias)
        return self.finish(decided) if self.finish else decided

    def _latest(self, drops: list[int], shape: DataFrame, where: Column | None = None) -> DataFrame:
        """The newest row of every entity in ``drops``; one row per entity and drop is aggregated, never a window."""
        rows = self._read("decided", self._decided_schema(shape), drops)
        rows = rows if where is None else rows.where(where)
        columns = [c for c in shape.columns if c != self.id_alias]
        newest = rows.groupBy(ref(self.id_alias)).agg(F.max_by(F.struct(*[ref(c) for c in columns]), "drop").alias("_row"))
        return newest.select(ref(self.id_alias), *[F.col("_row")[c].alias(c) for c in columns])

    # -- reads --------------------------------------------------------------
    def current(self) -> DataFrame:
        """One row per entity, as of the last drop that counts."""
        return self._latest(self.drops(), self._shape())

    def changes(self, drop: int) -> DataFrame:
        """The rows that drop ``drop`` brought or changed; ``change`` is ``insert`` or ``update``."""
        shape = self._shape()
        path = f"{self.root}/decided/drop={drop}"
        schema = self._decided_schema(shape)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/decided").parquet(path).select(*shape.columns, "change")

    def compact(self) -> int:
        """Write the states and rows of all drops as one new drop, from which later ones start; returns its number."""
        drops = self.drops()
        drop = max(drops, default=0) + 1
        shape = self._shape()
        states = empty_states(self.spark, self.variables)
        merged = merge_states(self._read("states", self._state_schema(states), drops), self.variables)
        merged.withColumn("bucket", self._bucket("_id")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/states/drop={drop}")
        rows = self._latest(drops, shape).withColumn("change", F.lit("compact")).withColumn("bucket", self._bucket(self.id_alias))
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/decided/drop={drop}")
        self._fs.mkdirs(self._Path(f"{self.root}/compacted/drop={drop}"))   # last: until then readers take the drops one by one
        return drop


def empty_states(spark: SparkSession, variables: dict) -> DataFrame:
    """An empty frame with the columns of ``file_states``."""
    fields = ["_id string", f"`{FILE_COL}` string"]
    for name, spec in variables.items():
        if isinstance(spec, Single):
            fields += [f"`{name}__kmin` string", f"`{name}__kmax` string"]
        elif isinstance(spec, Classes):
            fields += [f"`{name}__{cls}` int" for cls, _ in spec.classes]
        else:
            fields.append(f"`{name}` int")
    return spark.createDataFrame([], ", ".join(fields))
