"""Large CSV files with quoted line breaks, read by many tasks.

Spark's multi-line reader takes one task a file.  Here the lines of such a file
are read by the text reader, split as usual, and put together again:

* whether a line begins inside a quoted field is the parity of all quote
  characters in front of it.  It is the parity of the blocks in front (one
  number a block, combined over the blocks of a file) and that of the lines in
  front in its own block (a window over one block, never over a file);
* a line that begins outside quotes and leaves them closed is a record; only the
  pieces of the others are grouped, by the line that opens their record, which
  may lie in an earlier block;
* records are parsed by ``from_csv``.

Parity says the same as a parser only where quotes open and close whole fields.
``parity_safe`` checks that against every record; other files are left to the
multi-line reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.session import checkpoint_dir


def _odd(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"')))) % 2


def _lines(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """``path, block, at, value, odd``: the lines of files in the order of (block, at), blanks between them too."""
    return (spark.read.option("lineSep", "\n").text(patterns)
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), "value")
            .withColumn("odd", _odd(F.col("value"))))


def _opened(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """Lines with ``inside`` (whether they begin in quotes) and ``opener``, the place of the last line of their block
    that opens a record (null before the first)."""
    blocks = (spark.read.option("lineSep", "\n").text(patterns)
              .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
              .groupBy("path", "block").agg((F.sum(_odd(F.col("value"))) % 2).alias("odd_block")))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", F.coalesce(F.sum("odd_block").over(earlier) % 2, F.lit(0)).alias("start"))
    order = Window.partitionBy("path", "block").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    lines = _lines(spark, patterns).join(blocks, ["path", "block"])
    lines = lines.withColumn("inside", (F.col("start") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 1).drop("start")
    return lines.withColumn("opener", F.last(F.when(~F.col("inside"), F.col("at")), True).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def records(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """``path, record, header, crlf`` for every record of CSV files: its whole text, without the line end.

    ``patterns`` are paths as the readers take them.  Empty lines between
    records are none.  ``header`` marks the first record of a file that is not
    blank, ``crlf`` the files whose first line ends with a carriage return and a
    line feed: such pairs become line feeds there, also inside quotes, and in
    other files stay, as in the multi-line reader.  A quote that is still open
    where a file ends makes one record of all lines after it.
    """
    lines = _opened(spark, patterns)
    # One row a block: its last opener, its first line that opens a record with text, and how its first line ends.
    opens = ~F.col("inside")
    blocks = lines.groupBy("path", "block").agg(
        F.max(F.when(opens, F.col("at"))).alias("last"),
        F.min(F.when(opens & (F.trim(F.rtrim(F.translate("value", "\r\t", "  "))) != ""), F.col("at"))).alias("first"),
        F.min(F.struct("at", F.endswith("value", F.lit("\r")).alias("cr"))).alias("top"))
    by_block = Window.partitionBy("path").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    all_blocks = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "path", "block", F.first("top.cr").over(all_blocks).alias("crlf"), F.last("last", True).over(earlier).alias("open_at"),
        F.last(F.when(F.col("last").isNotNull(), F.col("block")), True).over(earlier).alias("open_block"),
        F.first("first", True).over(all_blocks).alias("first"),
        F.first(F.when(F.col("first").isNotNull(), F.col("block")), True).over(all_blocks).alias("first_block"))
    lines = lines.join(blocks, ["path", "block"])
    whole = ~F.col("inside") & (F.col("odd") == 0)
    single = lines.where(whole).select("path", "crlf", F.col("value").alias("record"),
                                       ((F.col("block") == F.col("first_block")) & (F.col("at") == F.col("first"))).alias("header"))
    pieces = lines.where(~whole).select(
        "path", "crlf", "block", "at", "value", "first", "first_block",
        F.coalesce("opener", "open_at").alias("opener"), F.when(F.col("opener").isNotNull(), F.col("block")).otherwise(F.col("open_block")).alias("open_block"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    joined = (pieces.groupBy("path", "crlf", "open_block", "opener", "first", "first_block").agg(text.alias("record"))
              .select("path", "crlf", "record", ((F.col("open_block") == F.col("first_block")) & (F.col("opener") == F.col("first"))).alias("header")))
    plain = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    found = single.unionByName(joined).withColumn("record", F.when(F.col("crlf"), plain).otherwise(F.col("record")))
    return found.where("record <> ''").withColumn("header", F.coalesce("header", F.lit(False)))


def _whole_fields(record: Column) -> Column:
    """Whether all quotes of a record open or close a whole field, or stand doubled in one.

    Split at quotes, every second piece is outside of them (or nothing, between
    doubled ones): it must begin and end with the comma of a neighbouring field.
    """
    parts = F.split(record, '"', -1)
    count = F.size(parts)
    wrong = F.filter(parts, lambda x, i: (i % 2 == 0) & (x != "") & (((i > 0) & ~F.startswith(x, F.lit(",")))
                                                                       | ((i < count - 1) & ~F.endswith(x, F.lit(",")))))
    return (count % 2 == 1) & (F.size(wrong) == 0)


def _safe(rows: DataFrame, file: str) -> set[str]:
    """Values of ``file`` whose records all are what a parser reads, by one pass over them."""
    loose = F.contains("record", F.lit('"')) & ~_whole_fields(F.col("record"))
    found = rows.groupBy(file).agg(F.max(loose | F.endswith("record", F.lit("\r"))).alias("bad"))
    return {r[file] for r in found.where(~F.col("bad")).collect()}


def parity_safe(spark: SparkSession, patterns: list[str]) -> set[str]:
    """Paths of the files in which every quote opens or closes a whole field and lines end alike, so that ``records`` gives
    what a parser does."""
    return _safe(records(spark, patterns), "path")


def checked_records(spark: SparkSession, patterns: list[str]) -> tuple[DataFrame, set[str]]:
    """``name, record, header`` of CSV files, and the names of those that are parity safe, names as they are in paths.

    A file has as many tasks as splits, and each pass over its lines all of
    them: the records that are checked are kept in the checkpoint folder, and
    ``read_quoted`` reads those.
    """
    checkpoint_dir(spark)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    rows = records(spark, patterns).select(name, "record", "header").checkpoint()
    return rows, _safe(rows, "name")


def read_quoted(rows: DataFrame, schema: T.StructType, corrupt: str, file_col: str) -> DataFrame:
    """Rows of ``schema`` (``corrupt`` last) and ``file_col``, as the multi-line reader gives them, without headers, of
    ``rows(name, record, header)``."""
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "multiLine": "true"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    file = F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B")))
    return rows.where(~F.col("header")).select(F.from_csv("record", ddl, options).alias("r"), file.alias(file_col)).select("r.*", file_col)
