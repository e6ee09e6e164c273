"""File discovery and CSV scans.

Files are listed once on the driver (metadata only), grouped by identical
header, and each group is read with one ``spark.read.csv`` call whose schema is
all strings.  Spark aligns multi-file CSV by position, so files with different
headers must never share a read; the groups are then aligned by name.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.labels import NULL_TOKENS, canonical_id, null_tokens
from wardline.functions.refs import ref
from wardline.sources.model import FILE_COL, Source, SourceSet
from wardline.sources.quoted import checked_records, read_quoted

CORRUPT_COL = "_corrupt_record"


@dataclass(frozen=True)
class SourceFile:
    name: str
    path: str
    type: str  # "csv" or "excel"
    size: int = 0


def file_type(name: str) -> str | None:
    """'csv' for ``.csv`` and 'excel' for ``.xlsx``, in any case; None for other files."""
    lower = name.lower()
    if lower.endswith(".csv"):
        return "csv"
    if lower.endswith(".xlsx"):
        return "excel"
    return None


def list_folder(spark: SparkSession, directory: str) -> list[SourceFile]:
    """Every entry directly in ``directory``, hidden ones too, through the Hadoop file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return [SourceFile(st.getPath().getName(), st.getPath().toString(), "folder" if st.isDirectory() else "file", int(st.getLen()))
            for st in found]


def glob_safe(path: str) -> str:
    """``path`` as a pattern that matches just itself: readers take paths as globs."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def discover(spark: SparkSession, directory: str) -> list[SourceFile]:
    """Non-recursive listing of the tabular files in ``directory``.

    Spark's readers skip files whose name starts with ``_`` or ``.``, and nothing
    here decodes ``.xls``: a tabular file of either kind is an error that names it.
    """
    found, refused = [], []
    for f in list_folder(spark, directory):
        kind = file_type(f.name) if f.type == "file" else None
        if f.type == "file" and f.name.lower().endswith(".xls"):
            refused.append(f"{f.name} (convert it to .xlsx)")
        elif kind is not None and f.name[0] in "_.":
            refused.append(f"{f.name} (rename it: readers skip hidden files)")
        elif kind is not None:
            found.append(SourceFile(f.name, f.path, kind, f.size))
    if refused:
        raise ValueError(f"Tabular files that cannot be read: {', '.join(sorted(refused))}")
    if not found:
        raise ValueError(f"No csv or excel files found in {directory}")
    return sorted(found, key=lambda f: f.name)


def read_csv_header(spark: SparkSession, path: str) -> list[str]:
    """Header of one CSV file; reads the first line only."""
    return spark.read.option("header", True).option("multiLine", True).csv(glob_safe(path)).columns


HEADER_BYTES = 1 << 20  # a first line that is longer is left to the CSV reader
HEADER_THREADS = 16


def read_csv_headers(spark: SparkSession, files: list[SourceFile]) -> dict[str, list[str]]:
    """Headers of many CSV files: a partial read of each through the Hadoop file system, no Spark job over them.

    The driver reads first lines on a few threads, then has Spark's CSV reader
    parse each distinct one.  A header whose first line has an open quote goes
    on in the next line; it is read by itself, as is one of over
    ``HEADER_BYTES`` bytes.
    """
    if not files:
        return {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f.path), files))
    headers = {}
    parsed: dict[str, list[str]] = {}
    for f, line in zip(files, lines):
        if line is None or line.count('"') % 2:
            headers[f.name] = read_csv_header(spark, f.path)
            continue
        if line not in parsed:  # one parse per distinct header
            parsed[line] = spark.read.option("header", True).csv(spark.sparkContext.parallelize([line], 1)).columns
        headers[f.name] = parsed[line]
    return headers


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file that is not blank; None without one, or where it is too long."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(conf).open(where)
    try:
        reader, text = jvm.org.apache.hadoop.util.LineReader(stream, conf), jvm.org.apache.hadoop.io.Text()
        while True:
            read = reader.readLine(text, HEADER_BYTES, HEADER_BYTES)
            line = text.toString().removeprefix("\ufeff")
            if read == 0 or text.getLength() >= HEADER_BYTES:
                return None
            if line.strip():
                return line
    finally:
        stream.close()


def check_id_column(headers: dict[str, list[str]], id_column: str) -> str:
    """The id column must be in every file (P6); the error lists the offenders."""
    missing = sorted(name for name, cols in headers.items() if id_column not in cols)
    if missing:
        raise AssertionError(f"Files missing primary id column {id_column}: {missing}")
    return id_column


def _field_count(line: F.Column) -> F.Column:
    """Number of comma-separated fields in a raw CSV line, quotes respected."""
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.size(F.split(unquoted, ",", -1))


def split_safe(spark: SparkSession, files: list[SourceFile]) -> set[str]:
    """Names of the files with no quoted line break, found in one parallel pass over every file.

    With quotes escaped by doubling, a line has an odd number of quote
    characters exactly when a quoted field continues on the next line.  Files
    without such a line can be read line by line, that is split across tasks.
    In the others a carriage return may only stand before a line feed: elsewhere
    the two readers would take it differently, so such a file is refused.
    """
    if not files:
        return set()
    odd = lambda x: (F.length(x) - F.length(F.replace(x, F.lit('"')))) % 2 == 1
    pieces = F.exists(F.split("value", "\r", -1), odd)  # a carriage return ends a line
    returns = F.contains("value", F.lit("\r"))
    broken = F.when(returns, pieces).otherwise(odd(F.col("value")))
    lines = spark.read.option("lineSep", "\n").text([glob_safe(f.path) for f in files])
    found = (lines.groupBy(F.col("_metadata.file_name").alias("name"))
             .agg(F.max(broken).alias("broken"), F.max(returns & F.col("value").rlike("\r(?!$)")).alias("lone"))
             .where("broken").select(F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))).alias("name"), "lone").collect())
    lone = sorted(r["name"] for r in found if r["lone"])
    if lone:
        raise ValueError(f"Carriage returns inside lines of files with quoted line breaks: {', '.join(lone)}")
    unsafe = {r["name"] for r in found}
    return {f.name for f in files} - unsafe


def joinable(spark: SparkSession, files: list[SourceFile]) -> set[str]:
    """Names of the files with quoted line breaks that are larger than a split and that parity of quotes reads rightly.

    Smaller ones are a single task of either reader, which give the same rows.
    """
    return _joined(spark, files)[1]


def _joined(spark: SparkSession, files: list[SourceFile]) -> tuple[DataFrame | None, set[str]]:
    """The records of the files that are larger than a split, and the names of those that are ``joinable``."""
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    large = [f for f in files if f.size > split]
    if not large:
        return None, set()
    rows, safe = checked_records(spark, [glob_safe(f.path) for f in large])
    found = {unquote(n) for n in safe}
    return rows.where(F.col("name").isin(sorted(safe))), {f.name for f in large if f.name in found}


def _read_csv(spark: SparkSession, paths: list[str], schema: T.StructType, multiline: bool) -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multiline)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .option("enforceSchema", True)   # the schema is the header of these very files
            .csv([glob_safe(p) for p in paths])
            .withColumn(FILE_COL, file_name()))


def file_name() -> F.Column:
    """The name of a row's file as it is in the folder (the metadata column has it percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def clean_rows(raw: DataFrame, header: list[str], id_column: str, tokens=NULL_TOKENS) -> DataFrame:
    """Rows of a raw CSV read (all strings, ``CORRUPT_COL``, ``FILE_COL``), cleaned the same way for batch and stream.

    Lines of blanks only are not records.  Short rows are kept with nulls; a row
    with more fields than the header fails the job naming the file.
    """
    text = ref(CORRUPT_COL)
    blank = text.rlike(r"^[\x20\t]*$") if len(header) > 1 else ref(header[0]).isNull() | (F.trim(ref(header[0])) == "")
    raw = raw.where(~F.coalesce(blank, F.lit(False)))
    too_long = text.isNotNull() & (_field_count(text) > len(header))
    guard = F.when(too_long, F.raise_error(F.concat(
        F.lit("Failed parsing "), ref(FILE_COL), F.lit("; row has more fields than the header: "), text)))
    cols = [F.coalesce(guard, canonical_id(null_tokens(ref(id_column), tokens))).alias(id_column)]
    cols += [null_tokens(ref(c), tokens).alias(c) for c in header if c != id_column]
    return raw.select(*cols, ref(FILE_COL))


def read_csv_group(spark: SparkSession, files: list[SourceFile], header: list[str], id_column: str,
                   multiline: bool | str = "auto", tokens=NULL_TOKENS) -> Source:
    """Read CSV files sharing ``header`` as one all-string DataFrame.

    Quotes are escaped by doubling; a carriage return, alone or with a line
    feed, ends a line, and lines of blanks only are skipped.
    ``multiline=True`` honours quoted line breaks but makes each file a single
    task; ``False`` splits files but breaks such records; ``"auto"`` looks for
    quoted line breaks in every file (``split_safe``) and splits the files
    without; files with some that are larger than one split are put together
    from their lines (``joinable``).  See ``clean_rows`` for short and long rows.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header]
                          + [T.StructField(CORRUPT_COL, T.StringType())])
    if multiline == "auto":
        safe = split_safe(spark, files)
        records, joined = _joined(spark, [f for f in files if f.name not in safe])
        whole = [f.path for f in files if f.name not in safe | joined]
        split = [f.path for f in files if f.name in safe]
        parts = ([_read_csv(spark, whole, schema, True)] if whole else []) + \
                ([_read_csv(spark, split, schema, False)] if split else []) + \
                ([read_quoted(records, schema, CORRUPT_COL, FILE_COL)] if joined else [])
        df = reduce(DataFrame.unionByName, parts)
    else:
        df = _read_csv(spark, [f.path for f in files], schema, bool(multiline))

    def reopen(names: tuple[str, ...]) -> Source:
        return read_csv_group(spark, [f for f in files if f.name in names], header, id_column, multiline, tokens)

    return Source(clean_rows(df, header, id_column, tokens), id_column, tuple(f.name for f in files), reopen)


def load_directory(spark: SparkSession, directory: str, id_column: str, multiline: bool | str = "auto",
                   tokens=NULL_TOKENS, skip: Collection[str] = ()) -> SourceSet:
    """List, check and read every tabular file of ``directory`` (S1-S3, P6) but those named in ``skip``.

    Returns one ``Source`` per distinct header.  Excel files are decoded by
    ``wardline.sources.excel``.
    """
    from wardline.sources.excel import excel_headers, read_excel_group

    files = [f for f in discover(spark, directory) if f.name not in skip]
    csv_files = [f for f in files if f.type == "csv"]
    xls_files = [f for f in files if f.type == "excel"]
    headers = read_csv_headers(spark, csv_files)
    if xls_files:
        found = excel_headers(spark, xls_files)
        headers.update({f.name: found.get(f.name, []) for f in xls_files})   # empty sheet: no header
    check_id_column(headers, id_column)
    groups: dict[tuple[str, tuple[str, ...]], list[SourceFile]] = defaultdict(list)
    for f in files:
        groups[(f.type, tuple(headers[f.name]))].append(f)
    sources = []
    for (kind, header), members in sorted(groups.items(), key=lambda kv: kv[1][0].name):
        if kind == "csv":
            sources.append(read_csv_group(spark, members, list(header), id_column, multiline, tokens))
        else:
            sources.append(read_excel_group(spark, members, list(header), id_column, tokens))
    return SourceSet(sources, id_column)
