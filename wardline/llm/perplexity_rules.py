"""Quality rules and n-gram perplexity under a modified Kneser-Ney model of the corpus.

The model is one of code points (a text's words joined by one space), for each
language by itself, with a history of three.  Tasks hand over the distinct
n-grams of chunks of documents; Spark counts them, derives the continuation
counts, discounts and back-off weights of the lower orders by aggregates and
joins, and the probabilities of all n-grams are stored as shards of sorted
64-bit hashes.  Each chunk's n-grams are looked up in the shards, and only the
answers travel to the chunk's documents.  Neither the model nor the corpus
passes one task, and nothing is broadcast: both may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wardline.llm.common import materialise

CHUNK_CHARS = 16_000_000  # characters and documents of a chunk
CHUNK_DOCS = 200_000
PIECE_CHARS = 1_000_000  # characters that are compressed, or whose n-grams are sorted, at a time
PIECE_LEVEL = 6  # of zstd: pieces are a fifth smaller than at its first level
SHARD = 400_000  # n-grams of a shard of the model
SALTS = 32  # parts of a language in joins by language

_U = np.uint64
_BITS = 21  # of a symbol: a code point, or one of the two marks
_START, _END = 0x110000, 0x110001
_ONE, _TWO = (1 << _BITS) - 1, (1 << 2 * _BITS) - 1
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
FALLBACK = (0.5, 1.0, 1.5)  # discounts of orders whose counts of counts give none


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalising step of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _words(text: str) -> list[bytes]:
    """The words of a text in UTF-8: bytes are split at the six ASCII blanks, and no other character holds one."""
    return text.encode("utf-8", "surrogatepass").split()


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First symbol, and the three others packed, of every 4-gram of a text; none for a text without words."""
    if not words:
        return np.empty(0, _U), np.empty(0, _U)
    joined = b" ".join(words)
    wide = joined if joined.isascii() else joined.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(wide, np.uint8 if wide is joined else np.uint32)
    s = np.concatenate([[_START] * 3, codes, [_END]]).astype(_U)
    return s[:-3], (s[1:-2] << _U(2 * _BITS)) | (s[2:-1] << _U(_BITS)) | s[3:]


def _hash(lang: int, first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return _mix(rest + _mix(first + _U(lang << _BITS)))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_chars: int) -> Iterator[tuple[int, list[tuple]]]:
    """(number, [(id, language, text)]) of bounded parts of a task's rows; a longer text is a part by itself."""
    chunk, held, rows = TaskContext.get().partitionId() << 24, 0, []
    for batch in batches:
        for doc, lang, text in zip(*batch.columns):
            rows.append((doc, lang.as_py(), text.as_py()))
            held += len(rows[-1][2])
            if held >= chunk_chars or len(rows) >= CHUNK_DOCS:
                yield chunk, rows
                chunk, held, rows = chunk + 1, 0, []
    if rows:
        yield chunk, rows


class _Counts:
    """Distinct n-grams of one language in a chunk, with their number."""

    def __init__(self, lang: int):
        self.lang, self.new, self.size, self.sums = lang, [], 0, None

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        for at in range(0, len(first), PIECE_CHARS):
            self.new.append((first[at:at + PIECE_CHARS], rest[at:at + PIECE_CHARS], np.ones(len(first[at:at + PIECE_CHARS]), np.int64)))
            self.size += len(self.new[-1][0])
            if self.size >= PIECE_CHARS:
                self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = self.new + ([self.sums] if self.sums else [])
        first, rest, n = (np.concatenate(x) for x in zip(*parts))
        same, kinds = pd.factorize(_hash(self.lang, first, rest))
        at = np.empty(len(kinds), np.int64)
        at[same[::-1]] = np.arange(len(same))[::-1]  # the first of equal ones
        self.sums, self.new, self.size = (first[at], rest[at], np.bincount(same, n).astype(np.int64)), [], 0
        return self.sums


_GRAMS = "chunk long, hash long, lang long, first long, rest long, n long"
_GRAM_NAMES = ["chunk", "hash", "lang", "first", "rest", "n"]


def _count(chunk_chars: int):
    """The distinct n-grams of every chunk, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in _chunks(batches, chunk_chars):
            yield from _gram_rows(chunk, rows)

    return run


def _gram_rows(chunk: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, _Counts] = {}
    for _, lang, text in rows:
        first, rest = _grams(_words(text))
        if len(first):
            counts.setdefault(lang, _Counts(lang)).add(first, rest)
    for lang, of in counts.items():
        first, rest, n = of.merge()
        hashes = _hash(lang, first, rest)
        order = np.argsort(hashes)
        first, rest, n, hashes = first[order], rest[order], n[order], hashes[order]
        columns = (np.full(len(n), chunk), hashes.view(np.int64), np.full(len(n), lang), first.view(np.int64), rest.view(np.int64), n)
        for at in range(0, len(n), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 100_000], pa.int64()) for c in columns], _GRAM_NAMES)


def text_rules(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    return _rules(text, _words(text))


def _rules(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(_BLANKS):
            seen.add(line)
    repeated = 0
    if len(words) > 8:
        h = np.fromiter(map(hash, words), np.int64, len(words)).view(_U)
        for i in (1, 2, 4):  # of two, four and eight words
            h = _mix(_mix(h[:-i]) + h[i:])
        same, _ = pd.factorize(h)
        at = np.flatnonzero(np.bincount(same)[same] > 1)
        cover = np.zeros(len(words) + 1, np.int64)
        cover[at] += 1
        np.add.at(cover, at + 8, -1)
        repeated = int((np.cumsum(cover) > 0).sum())
    return len(words), len(text) - sum(map(text.count, _BLANKS)), sum(map(text.count, _SYMBOLS)), dup, repeated


def _pack(chunk_chars: int):
    """The documents of the same chunks, as compressed pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in _chunks(batches, chunk_chars):
            yield from _pieces(chunk, rows)

    return run


def _pieces(chunk: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    at = 0
    while at < len(rows):
        end, held = at, 0
        while end < len(rows) and held < PIECE_CHARS:
            held, end = held + len(rows[end][2]), end + 1
        ids, langs, texts = zip(*rows[at:end])
        part = pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], ids[0].type), pa.array(langs, pa.int64()), pa.array(texts, pa.large_string())],
                                          ["id", "lang", "text"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", PIECE_LEVEL))) as out:
            out.write_batch(part)
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                                          pa.array([None], pa.binary())], ["chunk", "data", "scores"])
        at = end


def _shard(table: pa.Table) -> pa.Table:
    """One shard of the model: sorted hashes and their natural logarithms of probability."""
    hashes, logs = np.asarray(table["hash"]).view(_U), np.asarray(table["log_p"]).astype(np.float32)
    order = np.argsort(hashes, kind="stable")
    return pa.table({"shard": table["shard"][:1], "hashes": pa.array([hashes[order].tobytes()]), "logs": pa.array([logs[order].tobytes()])})


def _look_up(model: pa.Table, asked: pa.Table) -> pa.Table:
    """The answers of one shard, a row for each chunk that asks."""
    hashes = np.frombuffer(model["hashes"][0].as_py(), _U) if len(model) else np.empty(0, _U)
    logs = np.frombuffer(model["logs"][0].as_py(), np.float32) if len(model) else np.empty(0, np.float32)
    chunks, keys = np.asarray(asked["chunk"]), np.asarray(asked["hash"]).view(_U)
    order = np.argsort(chunks, kind="stable")
    chunks, keys = chunks[order], keys[order]
    out: tuple[list, list, list] = ([], [], [])
    for at in np.split(np.arange(len(chunks)), np.flatnonzero(np.diff(chunks)) + 1):
        if len(at):
            place = np.searchsorted(hashes, keys[at])
            if place.max() >= len(hashes) or (hashes[place] != keys[at]).any():
                raise ValueError("an n-gram is not in the model: the documents changed between two reads")
            for column, value in zip(out, (int(chunks[at[0]]), keys[at].tobytes(), logs[place].tobytes())):
                column.append(value)
    return pa.table({"chunk": pa.array(out[0], pa.int64()), "data": pa.array(out[1], pa.binary()), "scores": pa.array(out[2], pa.binary())})


_RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _score(id_type: pa.DataType):
    """Of a chunk: rules, number of symbols and negative logarithm of probability of each document."""

    def run(table: pa.Table) -> pa.Table:
        given = table["scores"].is_valid()
        answers = table.filter(given)
        hashes = np.concatenate([np.frombuffer(x.as_buffer(), _U) for x in answers["data"]] or [np.empty(0, _U)])
        logs = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in answers["scores"]] or [np.empty(0, np.float32)])
        order = np.argsort(hashes, kind="stable")
        answered, logs = pd.Index(hashes[order]), logs[order].astype(np.float64)
        out: list[list] = [[] for _ in range(9)]
        for piece in table.filter(pc.invert(given))["data"]:
            part = pa.ipc.open_stream(piece.as_buffer()).read_all()
            for doc, lang, text in zip(*part.columns):
                lang, text = lang.as_py(), text.as_py()
                words = _words(text)
                keys = _hash(lang, *_grams(words))
                place = answered.get_indexer(keys)
                if (place < 0).any():
                    raise ValueError("an n-gram has no answer: the documents changed between two reads")
                cost = -float(logs[place].sum())
                for column, value in zip(out, (doc.as_py(), lang, *_rules(text, words), len(keys), cost)):
                    column.append(value)
        types = [id_type, *[pa.int64()] * 7, pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "lang", *_RULES, "symbols", "cost"])

    return run


def _by_language(rows: DataFrame, per_language: DataFrame, spread: str) -> DataFrame:
    """Join on ``lang``, each language dealt to ``SALTS`` parts by the column ``spread``."""
    salted = per_language.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(salted, ["lang", "salt"]).drop("salt")


def _discounts(grams: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3``: discounts of counts of 1, 2 and more (Chen and Goodman), from the counts of counts of one order."""
    n = [F.col(f"n{i}") for i in range(1, 5)]
    of = grams.groupBy("lang").agg(*[F.count_if(F.col("c") == i).cast("double").alias(f"n{i}") for i in range(1, 5)])
    full = (n[0] > 0) & (n[1] > 0) & (n[2] > 0) & (n[3] > 0)
    share = F.when(full, n[0] / (n[0] + 2 * n[1]))
    d = [i + 1 - (i + 2) * share * F.try_divide(n[i + 1], n[i]) for i in range(3)]
    sound = full & (d[0].between(0, 1)) & (d[1].between(0, 2)) & (d[2].between(0, 3))
    return of.select("lang", *[F.when(sound, d[i]).otherwise(FALLBACK[i]).alias(f"d{i + 1}") for i in range(3)])


def _order(grams: DataFrame, history: Column, suffix: Column, lower: DataFrame | None) -> DataFrame:
    """``grams(lang, gram, c)`` with their interpolated probability ``p``; ``lower(lang, gram, p)`` is of the order below."""
    of = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = _by_language(grams, _discounts(grams), "rest").withColumn("d", of).drop("d1", "d2", "d3")
    rows = rows.withColumns({"history": history, "suffix": suffix})
    sums = rows.groupBy("lang", "history").agg(F.sum("c").alias("total"), F.sum("d").alias("freed"), F.count("*").alias("kinds"))
    if lower is None:
        rows = _by_language(rows, sums.drop("history"), "rest").withColumn("below", 1 / F.col("kinds"))
    else:
        below = lower.select("lang", F.col("rest").alias("suffix"), F.col("p").alias("below"))
        rows = rows.join(sums, ["lang", "history"]).join(below, ["lang", "suffix"])
    p = (F.col("c") - F.col("d") + F.col("freed") * F.col("below")) / F.col("total")
    return rows.select(*grams.columns, p.alias("p"))


def kneser_ney(grams: DataFrame) -> DataFrame:
    """``hash, log_p`` of every 4-gram of ``grams(hash, lang, first, rest, n)``: the model before it is sorted into shards.

    The highest order counts occurrences, the lower ones distinct symbols to the left.
    """
    four = materialise(grams.groupBy("lang", "first", "rest").agg(F.sum("n").alias("c"), F.min("hash").alias("hash")), "kn-4")
    three = materialise(four.groupBy("lang", "rest").agg(F.count("*").alias("c")), "kn-3")
    two = materialise(three.groupBy("lang", F.col("rest").bitwiseAND(_TWO).alias("rest")).agg(F.count("*").alias("c")), "kn-2")
    one = two.groupBy("lang", F.col("rest").bitwiseAND(_ONE).alias("rest")).agg(F.count("*").alias("c"))
    rest, cut = F.col("rest"), F.shiftright("rest", _BITS)
    p1 = materialise(_order(one, F.lit(0), F.lit(0), None), "kn-p1")
    p2 = materialise(_order(two, cut, rest.bitwiseAND(_ONE), p1), "kn-p2")
    p3 = materialise(_order(three, cut, rest.bitwiseAND(_TWO), p2), "kn-p3")
    p4 = _order(four, F.shiftleft("first", 2 * _BITS).bitwiseOR(cut), rest, p3)
    return p4.select("hash", F.log("p").alias("log_p"))


def _bands(scored: DataFrame, low: float, high: float, least_spread: float) -> DataFrame:
    """``lang, lower, upper``: fences around the quartiles of a language's scores, exact to 1/1000.

    Equal texts count once: they share number of symbols and cost.  Scores are
    counted by thousandths, so that a language takes a bounded number of rows.
    """
    each = scored.where("symbols > 0").select("lang", "symbols", "cost").distinct()
    bins = each.groupBy("lang", F.floor(1000 * F.col("cost") / F.col("symbols")).alias("bin")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.partitionBy("lang").orderBy("bin"))
    bins = bins.withColumns({"upto": upto, "all": F.sum("n").over(W.partitionBy("lang"))})
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bin"))) / 1000
    of = bins.groupBy("lang").agg(at(0.25).alias("q1"), at(0.75).alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least_spread))
    return of.select("lang", (F.col("q1") - low * spread).alias("lower"), (F.col("q3") + high * spread).alias("upper"))


def perplexity_rules(docs: DataFrame, least_words: int = 20, most_repeated: int = 30, low: float = 8.0, high: float = 12.0,
                     least_spread: float = 0.02, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity`` of every row.

    The first rules count words (at ASCII white space), their code points,
    symbols ``#*$%&|<>``, lines with a word that repeat an earlier line, and
    words in 8-word windows that occur twice or more; ``base_failed`` says that
    there are under ``least_words`` words, or that over ``most_repeated`` percent
    are repeated.  ``log_perplexity`` is the mean negative log probability of
    the code points under the model of the document's language, which counts
    all documents.  A document that did not fail is kept if that lies within
    the bands of its language: ``low`` times the quartiles' distance below the
    first one and ``high`` times above the third (or that often
    ``least_spread``, if they are nearer), taken over all different texts.

    Null and empty texts have no words, fail and have a null perplexity.  A null
    language is a language.  Rows that repeat an id, or all columns, are scored
    each; ties cannot matter.  Texts of any length are read whole, a chunk of
    them or one long text at a time.  Other columns are not read.  An empty
    table gives no rows.  ``docs`` is read twice and must give the same rows in
    the same tasks (files); otherwise the job ends with an error.
    """
    # 40 bits of a hash name a language; texts of two languages would share a model on a collision.
    lang = F.when(F.col(lang_col).isNull(), 0).otherwise(F.shiftrightunsigned(F.xxhash64(F.col(lang_col).cast("string")), 24))
    rows = docs.select(F.col(id_col).alias("id"), lang.cast("long").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    grams = materialise(rows.mapInArrow(_count(chunk_chars), _GRAMS), "kn-grams")

    logs = materialise(kneser_ney(grams), "kn-logs")
    shards = max(1, -(-logs.count() // SHARD))
    dealt = F.pmod(F.shiftright("hash", 8), F.lit(shards)).cast("int").alias("shard")
    model = materialise(logs.select("hash", "log_p", dealt).groupBy("shard").applyInArrow(_shard, "shard int, hashes binary, logs binary"), "kn-model")
    asked = grams.select("chunk", "hash", dealt)
    answers = model.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_look_up, "chunk long, data binary, scores binary")

    id_type = rows.schema["id"].dataType
    texts = rows.mapInArrow(_pack(chunk_chars), "chunk long, data binary, scores binary")
    schema = f"doc_id {id_type.simpleString()}, lang long, {', '.join(f'{c} long' for c in _RULES)}, symbols long, cost double"
    scored = texts.unionByName(answers).groupBy("chunk").applyInArrow(_score(to_arrow_type(id_type)), schema)
    scored = materialise(scored, "kn-scored")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    score = F.when(F.col("symbols") > 0, F.col("cost") / F.col("symbols"))
    bands = _bands(scored, low, high, least_spread)
    # Documents without words are of languages that may have no bands.
    rated = _by_language(scored.where("symbols > 0"), bands, "cost").unionByName(
        scored.where("symbols = 0").withColumns({"lower": F.lit(0.0), "upper": F.lit(0.0)}))
    return rated.select("doc_id", *_RULES, failed.alias("base_failed"),
                        (~failed & F.coalesce(score.between(F.col("lower"), F.col("upper")), F.lit(False))).alias("kept"),
                        score.alias("log_perplexity"))
