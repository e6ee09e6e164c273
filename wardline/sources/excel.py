"""Excel (.xlsx) scan through ``binaryFile`` + ``mapInPandas`` (S3).

Each workbook is one row of the ``binaryFile`` source; a Python task opens the
zip, reads the first sheet with the standard library and yields its rows as
``map<string,string>``.  The projection to named columns, null tokens and id
canonicalisation then runs in the JVM.  A sheet is bounded by the format
(1,048,576 rows), so one workbook per task is a bounded unit of work.
Legacy binary ``.xls`` is not decoded: convert it upstream.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wardline.functions.labels import NULL_TOKENS, canonical_id, null_tokens
from wardline.sources.model import FILE_COL, Source

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
# Built-in number formats that display dates (ECMA-376 part 1, 18.8.30).
_DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")
_EPOCH = datetime(1899, 12, 30)

ROW_SCHEMA = "_file string, _row long, cells map<string,string>"


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", _NS)
    rid = sheet.get(f"{{{_NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", _NS):
        if rel.get("Id") == rid:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
    raise ValueError("workbook has no first sheet")


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    st = ET.fromstring(z.read("xl/styles.xml"))
    custom = {}
    for fmt in st.findall("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", fmt.get("formatCode", "")).lower()
        custom[int(fmt.get("numFmtId"))] = bool(re.search(r"[dy]", code))
    styles = set()
    for i, xf in enumerate(st.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FORMAT_IDS or custom.get(fid, False):
            styles.add(i)
    return styles


def _number_text(v: str, is_date: bool) -> str:
    if is_date:
        stamp = _EPOCH + timedelta(seconds=round(float(v) * 86400))
        return stamp.strftime("%Y-%m-%d %H:%M:%S")
    f = float(v)
    return str(int(f)) if f.is_integer() and abs(f) < 2**53 else repr(f)


def iter_sheet(content: bytes, max_rows: int | None = None):
    """Rows of the first sheet of an .xlsx workbook as lists of text, streamed.

    The sheet XML is read incrementally (``iterparse``) and each row element is
    freed once decoded, so memory holds the shared strings and one row.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.findall("m:si", _NS)]
        date_styles = _date_styles(z)
        row_tag, cell_tag = f"{{{_NS['m']}}}row", f"{{{_NS['m']}}}c"
        emitted = 0
        with z.open(_first_sheet_path(z)) as stream:
            for _, row in ET.iterparse(stream, events=("end",)):
                if row.tag != row_tag:
                    continue
                values: dict[int, str | None] = {}
                for pos, cell in enumerate(row.iter(cell_tag)):
                    ref = cell.get("r")
                    idx = _col_index(_CELL_REF.match(ref).group(1)) if ref else pos
                    kind = cell.get("t", "n")
                    v = cell.find("m:v", _NS)
                    if kind == "s" and v is not None:
                        values[idx] = shared[int(v.text)]
                    elif kind == "inlineStr":
                        values[idx] = _text(cell)
                    elif kind == "b" and v is not None:
                        values[idx] = "True" if v.text == "1" else "False"
                    elif v is not None and v.text is not None:
                        if kind == "n":
                            values[idx] = _number_text(v.text, int(cell.get("s", "0")) in date_styles)
                        else:
                            values[idx] = v.text
                row.clear()
                width = max(values) + 1 if values else 0
                yield [values.get(i) for i in range(width)]
                emitted += 1
                if max_rows is not None and emitted >= max_rows:
                    return


def read_sheet(content: bytes, max_rows: int | None = None) -> list[list[str | None]]:
    """First sheet of an .xlsx workbook as rows of text (header row first)."""
    return list(iter_sheet(content, max_rows))


BATCH_ROWS = 10_000


def _unique(header: list[str]) -> list[str]:
    """Duplicate names get their position appended, as Spark's CSV reader does."""
    counts = {h: header.count(h) for h in header}
    return [f"{h}{i}" if counts[h] > 1 else h for i, h in enumerate(header)]


def _decode(header_only: bool):
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                name = posixpath.basename(path)
                rows = iter_sheet(content, max_rows=1 if header_only else None)
                first = next(rows, None)
                if first is None:
                    continue
                header = _unique([h if h is not None else f"Unnamed: {i}" for i, h in enumerate(first)])
                if header_only:
                    yield pd.DataFrame([(name, 0, {h: h for h in header})], columns=["_file", "_row", "cells"])
                    continue
                out = []
                for i, r in enumerate(rows):
                    if len(r) > len(header):
                        raise ValueError(f"Failed parsing {name}; row {i + 2} has more fields than the header")
                    out.append((name, i, {h: (r[j] if j < len(r) else None) for j, h in enumerate(header)}))
                    if len(out) >= BATCH_ROWS:
                        yield pd.DataFrame(out, columns=["_file", "_row", "cells"])
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=["_file", "_row", "cells"])
    return run


def _binary(spark: SparkSession, paths: list[str]):
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def excel_headers(spark: SparkSession, files) -> dict[str, list[str]]:
    """Header of each workbook (metadata-sized result)."""
    rows = _binary(spark, [f.path for f in files]).mapInPandas(_decode(True), ROW_SCHEMA).collect()
    headers = {}
    for r in rows:
        cells = r["cells"]
        headers[r["_file"]] = [cells[k] if cells[k] is not None else k for k in cells]
    return headers


def read_excel_group(spark: SparkSession, files, header: list[str], id_column: str,
                     tokens=NULL_TOKENS) -> Source:
    """Workbooks sharing ``header`` as one all-string DataFrame."""
    raw = _binary(spark, [f.path for f in files]).mapInPandas(_decode(False), ROW_SCHEMA)
    cols = [canonical_id(null_tokens(F.col("cells")[id_column], tokens), strip_float_suffix=True).alias(id_column)]
    cols += [null_tokens(F.col("cells")[c], tokens).alias(c) for c in header if c != id_column]
    cols.append(F.col(FILE_COL))

    def reopen(names: tuple[str, ...]) -> Source:
        return read_excel_group(spark, [f for f in files if f.name in names], header, id_column, tokens)

    return Source(raw.select(*cols), id_column, tuple(f.name for f in files), reopen)
