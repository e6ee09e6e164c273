"""WARC archives of pages, written and read as a table of record chunks.

Writing: a payload of more than ``chunk_chars`` characters becomes several rows
(record, chunk number), each a WARC segment record (``WARC-Segment-Number``,
type ``continuation`` after the first), written by Spark's text writer with the
record separator CRLF CRLF.  Reading: the text reader splits at CRLF CRLF; a
small state machine per archive follows ``Content-Length`` and the segment
headers and yields chunk rows with the SHA-1 and the length of the payload so
far.  Neither side ever builds a whole record.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import materialise

CHUNK_CHARS = 1 << 20
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + _END
_URN = "urn:wardline:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_plan(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``pages`` with ``payload, bytes, digest, refers_to``: of equal payloads of at least ``least_bytes`` bytes all
    rows but those of the largest page_id refer to it."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    equal = materialise(rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
                        .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n"),
                        "warc-equal")
    rows = rows.join(equal.withColumnRenamed("digest", "d").withColumnRenamed("bytes", "b"),
                     (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return rows.withColumn("refers_to", F.when(F.col("last").isNotNull(), refers)).drop("d", "b", "last")


def record_texts(plan: DataFrame, date: str = "2024-01-01T00:00:00Z", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The rows of an archive, one for each chunk of a record, without the separator at their end.

    A payload is cut into chunks in one pass, and a row carries its own chunk only.
    """
    revisit = F.col("refers_to").isNotNull()
    payload, size = F.col("payload"), F.length("payload")
    cut = F.regexp_extract_all(payload, F.lit(f"(?s).{{1,{chunk_chars}}}+"), F.lit(0))
    raw = F.transform(F.sequence(F.lit(0), F.ceil(size / chunk_chars).cast("int") - 1),  # a pattern would replace broken bytes
                      lambda i: F.substring(payload, i * chunk_chars + 1, F.lit(chunk_chars)))
    parts = F.when(revisit, F.array(F.lit(""))).when(size <= chunk_chars, F.array(payload)).when(F.is_valid_utf8(payload), cut).otherwise(raw)
    plan = plan.withColumn("parts", parts).drop("payload").withColumn("chunks", F.size("parts"))
    plan = plan.select("page_id", "url", "bytes", "digest", "refers_to", "chunks", F.posexplode("parts").alias("place", "part"))
    plan = plan.withColumn("chunk", F.col("place") + 1)
    name = F.concat(F.lit(_URN), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    first, many, part = F.col("chunk") == 1, F.col("chunks") > 1, F.col("part")
    block = F.when(revisit, "").otherwise(F.concat(F.when(first, _HTTP).otherwise(""), part))
    total = F.col("bytes") + len(_HTTP)

    def line(key: str, value: Column | str, when: Column | None = None) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        out = F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
        return out if when is None else F.when(when, out).otherwise("")

    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), name, F.when(first, "").otherwise(F.concat(F.lit(":chunk:"), F.col("chunk").cast("string"))), F.lit(">"))),
        line("WARC-Date", date), line("WARC-Target-URI", F.coalesce(uri, F.lit("")), uri.isNotNull() & first),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"), first),
        line("X-Payload-Length", F.col("bytes").cast("string"), revisit),
        line("WARC-Profile", _PROFILE, revisit),
        line("WARC-Refers-To", F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(">")), revisit),
        line("WARC-Segment-Number", F.col("chunk").cast("string"), many),
        line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), name, F.lit(">")), ~first),
        line("WARC-Segment-Total-Length", total.cast("string"), many & (F.col("chunk") == F.col("chunks"))),
        line("Content-Type", "application/http; msgtype=response", ~revisit),
        F.lit("Content-Length: "), F.octet_length(F.col("block")).cast("string"), F.lit(_END), F.col("block"))
    return plan.withColumn("block", block).select(header.alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, chunk_chars: int = CHUNK_CHARS) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` to gzip archives under ``path``.

    Null html is an empty payload, a null url is left out, a null page_id is
    written as "null" (and never referred to).  Of equal payloads of at least
    ``least_bytes`` bytes the record of the largest page_id is the response and
    the others revisit it; rows that repeat that id and payload are responses
    too.  The chunks of a record follow one another in one file.
    """
    record_texts(payload_plan(pages, least_bytes), chunk_chars=chunk_chars).write.option("lineSep", _END).option("compression", "gzip").text(path)


_CHUNKS = ("page_id long, url string, record_type string, refers_to long, chunk int, payload binary, "
           "payload_bytes long, payload_digest string, last boolean")
_CHUNKS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("chunk", pa.int32()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string()), ("last", pa.bool_())])


def _page(urn: str | None) -> int | None:
    key = (urn or "").strip("<>").removeprefix(_URN).split(":")[0]
    return int(key) if key.lstrip("-").isdigit() else None


class _Reader:
    """Follows the pieces between separators of one archive after the other."""

    def __init__(self, with_payload: bool):
        self.with_payload = with_payload
        self.left: int | None = None  # bytes of the block still to come; None before a header
        self.skip = 0  # bytes at the start of the next piece that end the record before
        self.record: dict | None = None

    def piece(self, data: bytes) -> Iterator[tuple]:
        data, self.skip = data[self.skip:], 0
        if self.left is None:
            if data.strip():
                yield from self.header(data)
            return
        # Separators inside the block are part of it.
        if len(data) < self.left:
            over = self.left - len(data) - 4
            body = data + b"\r\n\r\n"[:4 + min(0, over)]
            self.skip = max(0, -over) and 4 + over
            self.left = None if over < 0 else over
        else:
            body, self.left = data, None
        yield from self.block(body, self.left is None)

    def header(self, data: bytes) -> Iterator[tuple]:
        lines = data.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC header: {data[:80]!r}")
        h = dict(x.split(": ", 1) for x in lines[1:])
        self.left = int(h["Content-Length"])
        if h["WARC-Type"] != "continuation":
            self.record = {"row": (_page(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), h["WARC-Type"], _page(h.get("WARC-Refers-To"))),
                           "chunk": 0, "bytes": 0, "sha": hashlib.sha1(), "http": h["WARC-Type"] == "response", "held": b""}
        r = self.record
        r["more"] = "WARC-Segment-Number" in h and "WARC-Segment-Total-Length" not in h
        if h["WARC-Type"] == "revisit":
            r["bytes"], r["digest"] = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
        yield from ()

    def block(self, body: bytes, ends: bool) -> Iterator[tuple]:
        r = self.record
        if r["http"]:  # the HTTP header runs to the first empty line
            r["held"] += body
            at = r["held"].find(b"\r\n\r\n")
            if at < 0:
                return
            body, r["held"], r["http"] = r["held"][at + 4:], b"", False
        if r["row"][2] == "response":
            r["sha"].update(body)
            r["bytes"] += len(body)
        digest = r.get("digest") or r["sha"].hexdigest()  # of the payload so far
        last = ends and not r["more"]
        if body or last:
            yield (*r["row"], r["chunk"], body if self.with_payload else None, r["bytes"], digest, last)
            r["chunk"] += 1


def read_chunks(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The chunk table of the gzip archives under ``path``: ``page_id, url, record_type, refers_to, chunk,
    payload, payload_bytes, payload_digest, last``; bytes and digest are of the payload up to the chunk, so the
    row marked ``last`` has those of the whole.  An empty payload is one empty chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(with_payload)
        for batch in batches:
            rows: list[tuple] = []
            for value in batch.column(0):
                rows.extend(reader.piece(value.as_buffer().to_pybytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _CHUNKS_ARROW)], schema=_CHUNKS_ARROW)

    return spark.read.option("lineSep", _END).text(path).mapInArrow(run, _CHUNKS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, without payloads: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest``."""
    return read_chunks(spark, path, with_payload=False).where("last").drop("chunk", "payload", "last")
