"""Exact deduplication by progressive refinement (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import materialise

# Runs of white space that are not already one plain space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with every run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


BUCKETS = 1 << 18  # of keys that rows share; bounds the table that every task gets
SALTS = 64


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _keys(text: Column, prefix_chars: int) -> list[Column]:
    norm = normalised(text)
    return [F.length(norm).alias("__len"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("__prefix")]


def _bucket(length, prefix) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(BUCKETS))


def _refined(rows: DataFrame) -> DataFrame:
    """The rows that share length and prefix with another one."""
    shared = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    by_length = rows.join(shared(rows, "__len"), "__len", "left_semi")
    return by_length.join(shared(by_length, "__len", "__prefix"), ["__len", "__prefix"], "left_semi")


def _shared_buckets(docs: DataFrame, text_col: str, prefix_chars: int) -> DataFrame:
    """``__bucket`` of every (length, prefix) that several rows share: at most ``BUCKETS`` rows."""
    rows = _refined(materialise(docs.select(*_keys(F.col(text_col), prefix_chars)), "exact-keys"))
    return materialise(rows.select(_bucket("__len", "__prefix").alias("__bucket")).distinct(), "exact-buckets")


def _with_sha(docs: DataFrame, text_col: str, prefix_chars: int, buckets: DataFrame) -> DataFrame:
    """``docs`` and ``__sha``, null where no other row shares length and prefix; texts stay where they are read."""
    marked = F.broadcast(buckets.withColumn("__marked", F.lit(True)))
    return (docs.withColumn("__bucket", _bucket(*_keys(F.col(text_col), prefix_chars))).join(marked, "__bucket", "left")
            .withColumn("__sha", F.when(F.col("__marked"), _sha(F.col(text_col)))).drop("__bucket", "__marked"))


def _decided(hashed: DataFrame, alike: DataFrame) -> DataFrame:
    """Every row of ``hashed(doc_id, sha)`` with the decision on its own text; ``alike`` are those that can have copies."""
    groups = (alike.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
              .where("n > 1").withColumnRenamed("sha", "group_sha"))
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    of = lambda df: df.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                              F.col("doc_id").eqNullSafe(keep).alias("kept"), "sha")
    some = hashed.where("sha is not null")
    lone = hashed.where("sha is null").withColumns({"first_id": F.col("doc_id"), "n": F.lit(None).cast("long")})
    return of(some.join(groups, some["sha"] == groups["group_sha"], "left")).unionByName(of(lone))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64,
                 digest_all: bool = False) -> DataFrame:
    """Groups of equal normalised texts: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Refinement in three levels: rows are grouped by length of the normalised
    text, those that share a length by a hash of the first ``prefix_chars``
    characters, and only those that share both by SHA-256 of the full text.
    Levels exchange narrow keys, never texts; groups are aggregated before the
    shuffle, so a group with a third of all rows costs as many rows as tasks.
    Only survivors of the first two levels, found by the bucket of their length
    and prefix, have their content hashed when it is read again, so each row
    carries the hash of its own text, whatever its id.  ``digest_all`` hashes
    every text during the one scan instead, for callers that want
    ``text_sha256`` of all rows anyway (else it is null for rows that no other
    row resembles).

    Null and empty texts are equal and form a group.  Of a group the smallest
    id stays; null ids never stay if another id exists, and all stay if none
    does.  Rows that repeat an id and a text share the decision and count in
    ``group_size``; rows that repeat an id with another text are decided by
    their own.  An empty table gives none.
    """
    if digest_all:
        rows = docs.select(F.col(id_col).alias("doc_id"), *_keys(F.col(text_col), prefix_chars), _sha(F.col(text_col)).alias("sha"))
        rows = materialise(rows, "exact-keys")
        alike = _refined(rows)
    else:
        only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        rows = _with_sha(only, "text", prefix_chars, _shared_buckets(only, "text", prefix_chars)).select("doc_id", F.col("__sha").alias("sha"))
        rows = materialise(rows, "exact-hashes")
        alike = rows.where("sha is not null")
    return (_decided(rows, alike)
            .select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64) -> DataFrame:
    """``docs`` without the rows whose normalised text another row of smaller id has (any id is smaller than null)."""
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    buckets = _shared_buckets(only, "text", prefix_chars)
    hashed = materialise(_with_sha(only, "text", prefix_chars, buckets).select("doc_id", F.col("__sha").alias("sha")), "exact-hashes")
    # Rows of null id can share a text any number of times: they are spread over salts.
    gone = (_decided(hashed, hashed.where("sha is not null")).where("not kept").select(F.col("doc_id").alias("__gone_id"), F.col("sha").alias("__gone_sha")).distinct()
            .withColumn("__gone_salt", F.explode(F.when(F.col("__gone_id").isNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))))
    rows = _with_sha(docs, text_col, prefix_chars, buckets)
    rows = rows.withColumn("__salt", F.when(F.col(id_col).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int"))
    same = rows[id_col].eqNullSafe(gone["__gone_id"]) & (rows["__sha"] == gone["__gone_sha"]) & (rows["__salt"] == gone["__gone_salt"])
    return rows.join(gone, same, "left_anti").select(*docs.columns)
