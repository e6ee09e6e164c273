"""The registry store: versioned Parquet tables.

Layout: ``<root>/<table>/v<NNNNNN>/`` holds one complete snapshot.  Appends
add files to the current snapshot; rewrites (cascade delete) write the next
snapshot and only then become visible, because readers pick the highest
version with a ``_SUCCESS`` marker.  A plan never overwrites the path it
reads; a folder without the marker is what an interrupted job left, and the
next write of that version replaces it.  Paths go through the Hadoop FileSystem API, so any shared storage works.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.operators.validate import assert_none, duplicate_keys, guard_rows
from wardline.schemas import KEYS, TABLES, conform

FACT_TABLES = ("events", "measurements", "critical_care", "comorbidities")


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- versions -----------------------------------------------------------
    def _versions(self, table: str) -> list[int]:
        base = self._Path(f"{self.root}/{table}")
        if not self._fs.exists(base):
            return []
        found = []
        for st in self._fs.listStatus(base):
            name = st.getPath().getName()
            if name.startswith("v") and name[1:].isdigit() and self._fs.exists(self._Path(st.getPath(), "_SUCCESS")):
                found.append(int(name[1:]))
        return sorted(found)

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v{version:06d}"

    def current(self, table: str) -> str:
        versions = self._versions(table)
        if not versions:
            raise FileNotFoundError(f"table {table} does not exist; call create() first")
        return self._path(table, versions[-1])

    # -- K1 -----------------------------------------------------------------
    def create(self, overwrite: bool = False) -> "Registry":
        """Initialise every table empty; an existing registry is an error unless ``overwrite``."""
        exists = any(self._versions(t) for t in TABLES)
        if exists and not overwrite:
            raise FileExistsError(f"registry {self.root} exists; pass overwrite=True")
        for table, schema in TABLES.items():
            version = (self._versions(table) or [0])[-1] + 1
            self._store(self.spark.createDataFrame([], schema), table, version, "overwrite")
        return self

    def read(self, table: str) -> DataFrame:
        return self._stored(table).select(*TABLES[table].names)

    def _stored(self, table: str) -> DataFrame:
        """The current snapshot as it is stored."""
        return self.spark.read.schema(TABLES[table]).parquet(self.current(table))

    def _store(self, df: DataFrame, table: str, version: int, mode: str, stored: bool = False) -> None:
        """Write rows of one snapshot of a table; ``stored`` says that they come from the one before."""
        df.write.mode(mode).parquet(self._path(table, version))

    def _keep(self, table: str, doomed: DataFrame) -> DataFrame:
        """The stored rows of a table without those of the ``doomed(patient_id)``."""
        return self._stored(table).join(doomed, "patient_id", "left_anti")

    # -- K2, K3 -------------------------------------------------------------
    def append(self, table: str, df: DataFrame, validate: bool = True, check_keys: bool = True) -> None:
        """Append rows to the current snapshot (K2).

        Row checks (required, allowed values) run inside the write itself, so
        they cost no extra pass; a failing row fails the job and the commit
        protocol leaves no partial files.  Key uniqueness needs one
        aggregation over the batch and runs first, for keyed tables only;
        callers whose rows are unique by construction pass ``check_keys=False``.
        """
        df = conform(df, table)
        if validate:
            if check_keys and table in KEYS:
                assert_none(duplicate_keys(df, KEYS[table]), f"Duplicate keys in {table}")
            df = guard_rows(df, table)
        self.current(table)
        self._store(df, table, self._versions(table)[-1], "append")

    def add_patients(self, patients: DataFrame) -> DataFrame:
        """Insert the patients not yet registered; existing ones are kept (K3).

        The new rows are checkpointed once (shared checkpoint folder), so the
        source scan runs a single time even though the rows are both written
        and returned (for the audit).  An id that ``patients`` holds twice is refused.
        """
        from wardline.session import checkpoint_dir

        checkpoint_dir(self.spark)
        fresh = (conform(patients, "patients")
                 .join(self.read("patients").select("patient_id"), "patient_id", "left_anti")
                 .checkpoint())
        self.append("patients", fresh)
        return fresh

    def add_comorb_keys(self, keys: DataFrame) -> None:
        fresh = keys.select("comorb_name").distinct().join(self.read("comorb_key"), "comorb_name", "left_anti")
        self.append("comorb_key", fresh, check_keys=False)

    def log(self, op: str, entity_ids: DataFrame | None, message: str) -> None:
        """Audit rows: one per entity touched, or one for the whole operation (K8)."""
        if entity_ids is None:
            rows = self.spark.range(1).select(F.lit(None).cast("string").alias("entity_id"))
        else:
            rows = entity_ids.select(ref(entity_ids.columns[0]).cast("string").alias("entity_id"))
        audit = rows.select(F.current_timestamp().alias("ts"), F.lit(op).alias("op"), "entity_id",
                            F.lit(message).alias("message"))
        self._store(audit, "audit", self._versions("audit")[-1], "append")

    def log_rows(self, op: str, rows: DataFrame, entity_col: str, message: "F.Column") -> None:
        """Audit rows computed per input row: ``message`` is a Column (K8)."""
        audit = rows.select(F.current_timestamp().alias("ts"), F.lit(op).alias("op"),
                            ref(entity_col).cast("string").alias("entity_id"), message.alias("message"))
        self._store(audit, "audit", self._versions("audit")[-1], "append")

    # -- K5, K6 -------------------------------------------------------------
    def delete_patients(self, ids: DataFrame, id_column: str = "patient_id") -> None:
        """Remove patients and their events, measurements, stays and links (K5).

        Each table is rewritten as its next snapshot with a left anti join on
        the doomed ids; the dictionary (``comorb_key``) stays.  Reference
        lists are derived from live rows, so children vanish from them (K6).
        """
        from wardline.session import checkpoint_dir

        # Distinct ids, materialised once: reused by every table's anti join,
        # and a plain scan lets adaptive execution split a hot patient's
        # partition on the fact side.
        checkpoint_dir(self.spark)
        doomed = ids.select(ref(id_column).cast("string").alias("patient_id")).distinct().checkpoint()
        # Facts first: if the job dies on the way, no fact is left without its patient, and a retry finishes.
        for table in (*FACT_TABLES, "patients"):
            versions = self._versions(table)
            self._store(self._keep(table, doomed), table, versions[-1] + 1, "overwrite", stored=True)
        self.log("delete", doomed, "Deleted patient and associated documents")

    def delete_where(self, table: str, condition: "F.Column | str") -> None:
        """Remove the rows of one table matching ``condition`` (next snapshot).

        Deleting a child row is all "pull on delete" needs (K6): patient
        documents derive their child summaries from the live rows.
        """
        if table not in TABLES:
            raise ValueError(f"unknown table {table}")
        cond = F.expr(condition) if isinstance(condition, str) else condition
        versions = self._versions(table)
        kept = self._stored(table).where(~F.coalesce(cond, F.lit(False)))
        self._store(kept, table, versions[-1] + 1, "overwrite", stored=True)
        self.log("delete_rows", None, f"Deleted rows of {table} where {condition}")

    # -- J8 -----------------------------------------------------------------
    def children(self) -> DataFrame:
        """Every child row of every patient, in long form."""
        return patient_children(self.read("events"), self.read("measurements"), self.read("critical_care"), self.read("comorbidities"))

    def pages(self, page_size: int = 1000) -> DataFrame:
        """The children of every patient, nested in order into pages of at most ``page_size``."""
        from wardline.plans.pages import patient_pages

        return patient_pages(self.children(), page_size)

    def documents(self) -> DataFrame:
        """Per patient: basics plus counts and date spans of each child table."""
        return patient_documents(self.read("patients"), self.read("events"), self.read("measurements"),
                                 self.read("critical_care"), self.read("comorbidities"))


class BucketedRegistry(Registry):
    """A registry whose tables are bucketed and sorted by ``patient_id``.

    Patients lie in ``buckets`` buckets of their id: the parent check (J2) and
    insert-if-absent (K3) bring new rows to the stored ones, which are not
    shuffled.  A fact also has a part, 0 to ``parts`` - 1, and lies in the
    bucket of its patient and part, so a patient with a third of all facts is
    spread over as many buckets; a delete (K5) brings its ids to every part.
    Rows are dealt to buckets once, when they are written.

    The tables are external ones of the session's catalog, named after the
    folder, and are registered again by any session that opens it; ``buckets``
    and ``parts`` are kept with them and cannot change.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, parts: int = 8):
        super().__init__(spark, root)
        spec = f"{self.root}/buckets"
        if self._fs.exists(self._Path(f"{spec}/_SUCCESS")):
            made = spark.read.schema("buckets int, parts int").json(spec).first()
            self.buckets, self.parts = made["buckets"], made["parts"]
        elif any(self._versions(t) for t in TABLES):
            raise ValueError(f"{root} holds a registry without buckets")
        else:
            self.buckets, self.parts = int(buckets), int(parts)
            spark.createDataFrame([(self.buckets, self.parts)], "buckets int, parts int").coalesce(1).write.json(spec)

    def _keys(self, table: str) -> list[str]:
        if table == "patients":
            return ["patient_id"]
        return ["patient_id", "_part"] if table in FACT_TABLES else []

    def _name(self, table: str, version: int) -> str:
        return f"wardline_{hashlib.md5(self.root.encode()).hexdigest()[:16]}_{table}_v{version}"

    def _table(self, table: str, version: int) -> str:
        """The catalog name of a snapshot; its definition only points to the files, which carry their bucket in the name."""
        name, keys = self._name(table, version), self._keys(table)
        if not self.spark.catalog.tableExists(name):
            fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[table].fields] + ["`_part` int"] * (len(keys) - 1)
            self.spark.sql(f"create table {name} ({', '.join(fields)}) using parquet clustered by ({', '.join(keys)}) "
                           f"sorted by ({', '.join(keys)}) into {self.buckets} buckets location '{self._path(table, version)}'")
        return name

    def _stored(self, table: str) -> DataFrame:
        if not self._keys(table):
            return super()._stored(table)
        self.current(table)
        return self.spark.table(self._table(table, self._versions(table)[-1]))

    def _store(self, df: DataFrame, table: str, version: int, mode: str, stored: bool = False) -> None:
        keys = self._keys(table)
        if not keys:
            super()._store(df, table, version, mode)
            return
        if not stored:      # dealt as the buckets are, so that a task writes one file; stored rows lie in their buckets already
            if "_part" in keys:
                df = df.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(self.parts)).cast("int"))
            df = df.repartition(self.buckets, *keys)
        dealt = df.select(*TABLES[table].names, *keys[1:])
        if mode == "append":
            dealt.write.mode("append").format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys).saveAsTable(self._table(table, version))
            return
        name = self._name(table, version)
        self.spark.sql(f"drop table if exists {name}")      # an external table: its files stay, and are replaced
        (dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys)
         .option("path", self._path(table, version)).saveAsTable(name))

    def _keep(self, table: str, doomed: DataFrame) -> DataFrame:
        if table == "patients":
            return super()._keep(table, doomed)
        every = F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))).alias("_part")
        return self._stored(table).join(doomed.select("patient_id", every), ["patient_id", "_part"], "left_anti")


def cascade_delete(tables: dict[str, DataFrame], doomed: DataFrame, id_column: str = "patient_id") -> dict[str, DataFrame]:
    """The rows that survive deleting ``doomed`` ids from every table (K5).

    The distinct doomed ids are checkpointed once (shared folder): all tables
    reuse them, and as a plain scan they let adaptive execution split a hot
    id's partition on the fact side of each anti join.
    """
    from wardline.session import checkpoint_dir

    checkpoint_dir(doomed.sparkSession)
    ids = doomed.select(ref(id_column).cast("string").alias("_doomed")).distinct().checkpoint()
    out = {}
    for name, df in tables.items():
        key = "patient_id" if "patient_id" in df.columns else id_column
        out[name] = df.join(ids, ref(key).cast("string") == F.col("_doomed"), "left_anti")
    return out


def patient_children(events: DataFrame | None = None, measurements: DataFrame | None = None,
                     critical_care: DataFrame | None = None, comorbidities: DataFrame | None = None) -> DataFrame:
    """The children of every patient, a row each (J8): ``patient_id, child, name, date, time, value``.

    A union of narrow projections: nothing is shuffled, and no patient's
    children meet in one row.  ``value`` is the child's main value as text
    (destination, result, ICU days; none for comorbidities).
    """
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    result = F.coalesce(text("result_double"), F.col("result_string"), F.array_join("result_array", "|"))
    shapes = (("event", events, F.col("event_type"), "event_date", "event_time", F.col("destination")),
              ("measurement", measurements, F.col("result_name"), "result_date", "result_time", result),
              ("critical_care", critical_care, F.col("request_location"), "admission_date", "admission_time", text("icu_days")),
              ("comorbidity", comorbidities, F.col("comorb_name"), None, None, none))
    rows = [df.select("patient_id", F.lit(child).alias("child"), name.alias("name"),
                      (F.col(date) if date else F.lit(None)).cast("date").alias("date"),
                      (F.col(time) if time else F.lit(None)).cast("double").alias("time"), value.alias("value"))
            for child, df, name, date, time, value in shapes if df is not None]
    if not rows:
        raise ValueError("no child table given")
    return reduce(DataFrame.unionByName, rows)


def child_summary(children: DataFrame, date_col: str | None, prefix: str, id_column: str = "patient_id") -> DataFrame:
    """Count and date span of one child table per patient; partially aggregated."""
    aggs = [F.count(F.lit(1)).alias(f"n_{prefix}")]
    if date_col:
        aggs += [F.min(date_col).alias(f"first_{prefix}"), F.max(date_col).alias(f"last_{prefix}")]
    return children.groupBy(id_column).agg(*aggs)


def patient_documents(patients: DataFrame, events: DataFrame | None = None, measurements: DataFrame | None = None,
                      critical_care: DataFrame | None = None, comorbidities: DataFrame | None = None) -> DataFrame:
    """Patient rows with a summary of each child table given (J8); the children themselves: ``patient_children``.

    The document row carries counts and date spans, computed with map-side
    aggregation so a patient with a huge history never lands in one task.
    """
    doc = patients
    for child, date_col, prefix in ((events, "event_date", "events"), (measurements, "result_date", "measurements"),
                                    (critical_care, "admission_date", "critical_care"),
                                    (comorbidities, None, "comorbidities")):
        if child is not None:
            summary = child_summary(child, date_col, prefix)
            doc = doc.join(summary, "patient_id", "left").fillna(0, subset=[f"n_{prefix}"])
    return doc
