"""Presence index: which files can hold which entities.

Every file gets a bitmap of hashed ids, built by Spark's bitmap aggregates: an
id sets ``hashes`` of ``2**bits`` positions, kept as blocks of 32,768 bits, so a
file takes a row of 4 KB for each block that it touches.  A lookup tests the
positions of its ids and opens only the files that have them all: a file that
holds an id is always opened, another one seldom (about (n * hashes /
2**bits)**hashes for n ids in the file).  The index is a table in shared
storage; new files append their rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.labels import canonical_id
from wardline.functions.refs import ref
from wardline.sources.model import FILE_COL, Source, SourceSet

BLOCK_BITS = 32768  # bits of a bitmap that ``bitmap_construct_agg`` builds

_SCHEMA = "_file string, block long, bitmap binary, bits int, hashes int"


class PresenceIndex:
    def __init__(self, spark: SparkSession, root: str, bits: int = 22, hashes: int = 2):
        if not 15 <= bits <= 36 or not 1 <= hashes <= 8:
            raise ValueError("bits must be 15 to 36 and hashes 1 to 8")
        self.spark, self.root, self.bits, self.hashes = spark, root.rstrip("/"), bits, hashes
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _positions(self, entity: Column) -> Column:
        """The positions that an id sets, as an array."""
        return F.array(*[F.shiftrightunsigned(F.xxhash64(entity, F.lit(i)), 64 - self.bits) for i in range(self.hashes)])

    def read(self) -> DataFrame:
        if not self._fs.exists(self._Path(f"{self.root}/_SUCCESS")):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.root)

    def files(self) -> set[str]:
        """Names of the indexed files; one name per file reaches the driver, as any listing of them does."""
        return {r[FILE_COL] for r in self.read().select(FILE_COL).distinct().collect()}

    def add(self, sources: SourceSet) -> None:
        """Index the files of ``sources`` that are not indexed yet; reads their id column only."""
        known = self.files()
        fresh = []
        for s in sources:
            if s.files is None:
                raise ValueError("a presence index needs sources that list their files")
            new = tuple(f for f in s.files if f not in known)
            if new:
                fresh.append(s.subset(new))
        if not fresh:
            return
        rows = reduce(DataFrame.unionByName, [s.df.select(ref(s.id_column).alias("_id"), ref(FILE_COL)) for s in fresh])
        bit = F.explode(self._positions(F.col("_id"))).alias("_at")
        bits = rows.where(F.col("_id").isNotNull()).select(FILE_COL, bit)
        # The functions number blocks from 1 and positions within them from 0.
        blocks = (bits.groupBy(FILE_COL, F.bitmap_bucket_number("_at").alias("block"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bitmap")))
        # A file without ids is indexed, too: with an empty first block.
        empty = [(f, 0, bytearray(BLOCK_BITS // 8)) for s in fresh for f in s.files]
        blocks = blocks.unionByName(self.spark.createDataFrame(empty, "_file string, block long, bitmap binary"))
        blocks.withColumns({"bits": F.lit(self.bits), "hashes": F.lit(self.hashes)}).write.mode("append").parquet(self.root)

    def candidates(self, ids: DataFrame, id_column: str | None = None) -> DataFrame:
        """(``_file``, n_ids): the files that can hold any of ``ids``, and how many of them each can hold."""
        other = self.read().where((F.col("bits") != self.bits) | (F.col("hashes") != self.hashes)).limit(1).count()
        if other:
            raise ValueError(f"{self.root} was built with other bits or hashes")
        asked = ids.select(canonical_id(ref(id_column or ids.columns[0])).alias("_id")).where("_id is not null").distinct()
        at = asked.select("_id", F.explode(self._positions(F.col("_id"))).alias("_at"))
        # Both positions of an id may be one.
        at = at.distinct().select("_id", F.bitmap_bucket_number("_at").alias("block"), F.bitmap_bit_position("_at").alias("_bit"))
        need = at.groupBy("_id").agg(F.count(F.lit(1)).alias("_need"))
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftrightunsigned(_byte, cast(_bit % 8 as int)) & 1") == 1
        hit = at.join(self.read(), "block").withColumn("_byte", byte).where(is_set)
        found = hit.groupBy("_id", FILE_COL).agg(F.count(F.lit(1)).alias("_n")).join(need, "_id").where("_n = _need")
        return found.groupBy(FILE_COL).agg(F.count(F.lit(1)).alias("n_ids"))

    def prune(self, sources: SourceSet, ids: DataFrame, id_column: str | None = None) -> SourceSet:
        """``sources`` restricted to the files that can hold any of ``ids``; a file that is not indexed stays."""
        can = {r[FILE_COL] for r in self.candidates(ids, id_column).select(FILE_COL).collect()}
        indexed, kept = self.files(), []
        for s in sources:
            if s.files is None:
                kept.append(s)
                continue
            names = tuple(f for f in s.files if f in can or f not in indexed)
            if names:
                kept.append(s.subset(names))
        return SourceSet(kept, sources.id_column)

    def lookup(self, sources: SourceSet, ids: DataFrame, id_column: str | None = None) -> SourceSet:
        """The rows of ``ids`` in ``sources`` (S6); only files that can hold them are opened."""
        asked = ids.select(canonical_id(ref(id_column or ids.columns[0])).alias("_asked")).where("_asked is not null").distinct()
        pruned = self.prune(sources, ids, id_column)
        return SourceSet([_semi(s, asked) for s in pruned], sources.id_column)


def _semi(source: Source, asked: DataFrame) -> Source:
    return source.with_df(source.df.join(asked, ref(source.id_column) == F.col("_asked"), "left_semi"))
