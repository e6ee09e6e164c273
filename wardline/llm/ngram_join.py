"""Near-duplicate groups by an exact Jaccard join on word n-grams.

Token-combination prefixes.  Tokens (hashed n-grams) are put in the order of
their document frequency, rarest first.  Two sets of Jaccard similarity t share
their first shared tokens within short prefixes of both, so only prefixes are
indexed:

* a token that no other document has is never sent further;
* a *rare* token (at most ``rare`` documents) is an index key by itself;
* *frequent* tokens are spread over G classes by hash and each pair of tokens
  of one class is a key.  The prefix is longer by G for it: similar sets then
  share G + 1 tokens inside it, so one of them is rare, or two of them fall in
  one class.  G follows the set's size class; a set uses the G of its own and
  of the next class, as similar sets are at most one class apart.  Keys per
  document stay below a small multiple of its size.

Candidates are verified on whole token sets.  Groups are wanted, not all
pairs, so candidates that are already connected need no check: a first round
links each set to the smallest one with the same min-hash, a second to the
smallest one of each key, and a last one checks what is still in different
groups: pair by pair under keys of at most ``few_sets`` sets, and by blocks of
sets, as matrices of sets and tokens, under the others.  No step lists all
pairs of a frequent key, and nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardline.llm.common import components, drop_table, materialise

_U = np.uint64
CHUNK_TOKENS = 2_000_000  # tokens and sets of a chunk, which is what a task holds at once
CHUNK_SETS = 30_000
BLOCK_SETS = 512  # sets of a block
_COLUMNS = 8192  # tokens compared by one matrix product
_SPLIT = 1 << 20  # bytes of a text split into words at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalising step of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _words(text: str) -> Iterator[bytes]:
    """Lower-cased (A-Z only) words of ``text``, split a piece at a time."""
    data, at = text.encode("utf-8", "surrogatepass").lower(), 0
    while at < len(data):
        end = min(len(data), at + _SPLIT)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield from data[at:end].split()
        at = end


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word n-grams; with fewer words, of all words as one."""
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, _words(text or "")), dtype=np.uint64)
    if not len(words):
        return words
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, n * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for i in range(n):
        total += words[i:len(words) - n + 1 + i] * _U((2 * i + 3) * 0xD6E8FEB86659FD93 % (1 << 64) | 1)
    return np.unique(_mix(total))


_MAP = "p int, chunk long, blob binary, ids array<long>, ords array<int>, sizes array<int>, marks array<long>"
_MAP_ARROW = pa.schema([("p", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary()), ("ids", pa.list_(pa.int64())),
                        ("ords", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("marks", pa.list_(pa.int64()))])


def _identity(tokens: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers that name a set, together with its size."""
    return np.array([np.bitwise_xor.reduce(tokens), _mix(tokens ^ _U(0xA0761D6478BD642F)).sum()] if len(tokens) else [0, 0], np.uint64)


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    """512 parity bits of a set; two sets differ in at least as many tokens as bits."""
    bits = np.bincount((tokens >> _U(7)).astype(np.int64) & 511, minlength=512) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _spread(width: int, bits: int):
    """Per chunk of documents: tokens dealt to 2**bits parts as (48 low bits, set number), and one row
    that lists the chunk's documents and sets.  Equal sets of a chunk are one set."""

    def flush(chunk: int, ids, ords, sets, marks) -> pa.RecordBatch:
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
        part = (tokens >> _U(64 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        tokens, owner, part = tokens[order], owner[order], part[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else np.empty(0, int)
        low = (tokens >> _U(16 - bits)).view(np.uint8).reshape(-1, 8)[:, :6]
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(part)]):
            rows.append((int(part[a]), chunk, low[a:b].tobytes() + owner[a:b].tobytes(), None, None, None, None))
        rows.append((int(_mix(np.array([chunk], np.uint64))[0]) % (1 << bits), chunk, None, ids, ords, [len(s) for s in sets],
                     np.concatenate(marks) if marks else []))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _MAP_ARROW)], schema=_MAP_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, seen = TaskContext.get().partitionId() << 24, 0, {}
        ids, ords, sets, marks = [], [], [], []
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                s = shingle_set(text.as_py(), width)
                m = _identity(s)
                key = (len(s), int(m[0]), int(m[1]))
                if key not in seen:
                    seen[key] = len(sets)
                    sets.append(s)
                    marks += [m.view(np.int64), _bitmap(s)]
                    held += len(s)
                ids.append(doc.as_py())
                ords.append(seen[key])
                if held >= CHUNK_TOKENS or len(sets) >= CHUNK_SETS or len(ids) >= 20 * CHUNK_SETS:
                    yield flush(chunk, ids, ords, sets, marks)
                    chunk, held, seen = chunk + 1, 0, {}
                    ids, ords, sets, marks = [], [], [], []
        if ids:
            yield flush(chunk, ids, ords, sets, marks)

    return run


def _count(bits: int):
    """Of one part: the tokens that several sets have, with their frequency, back to their chunks."""

    def run(table: pa.Table) -> pa.Table:
        lists = table["ids"].is_valid()  # rows that list a chunk's documents pass as they are
        parts = table.filter(pc.invert(lists)).select(["p", "chunk", "blob"]).to_pylist()
        about, out = table.filter(lists).cast(_MAP_ARROW), []
        if parts:
            p, sizes = parts[0]["p"], [len(r["blob"]) // 8 for r in parts]
            low = np.zeros((sum(sizes), 8), np.uint8)
            low[:, :6] = np.concatenate([np.frombuffer(r["blob"], np.uint8, 6 * n).reshape(-1, 6) for r, n in zip(parts, sizes)])
            tokens = low.view(np.uint64).ravel() | _U(p << 48)
            owner = np.concatenate([np.frombuffer(r["blob"], np.uint16, n, 6 * n) for r, n in zip(parts, sizes)])
            place = np.repeat(np.arange(len(parts)), sizes)
            order = np.argsort(tokens, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(tokens[order]) != 0])
            count = np.diff(np.r_[starts, len(tokens)])
            df = np.empty(len(tokens), np.uint32)
            df[order] = np.repeat(count, count)
            shared = np.flatnonzero(df > 1)
            cuts = np.searchsorted(place[shared], np.arange(len(parts) + 1))
            for i, r in enumerate(parts):
                at = shared[cuts[i]:cuts[i + 1]]
                if len(at):
                    out.append((p, r["chunk"], tokens[at].tobytes() + df[at].tobytes() + owner[at].tobytes(), None, None, None, None))
        cols = zip(*out) if out else [[] for _ in _MAP_ARROW]
        return pa.concat_tables([about, pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _MAP_ARROW)], schema=_MAP_ARROW)])

    return run


def _classes(n: int, similarity: float) -> tuple[int, int]:
    """The size class of a set of ``n`` tokens and its number of frequent-token classes."""
    size = int(math.floor(math.log(n) / -math.log(similarity) + 1e-9))
    return size, _class_count(size, similarity)


def _class_count(size: int, similarity: float) -> int:
    return max(1, int(similarity ** -size / 16))


def index_keys(tokens: np.ndarray, df: np.ndarray, n: int, similarity: float, rare: int) -> np.ndarray:
    """Index keys of a set of ``n`` tokens of which ``tokens`` occur in other sets too."""
    least = math.ceil(similarity * n - 1e-9)  # a similar set shares as many tokens at least
    alone = n - len(tokens)
    if n < 3 or n - least + 1 <= alone:
        return np.empty(0, np.uint64)
    order = np.lexsort((tokens, df))
    tokens, df = tokens[order], df[order]
    size = _classes(n, similarity)[0]
    keys = []
    for scheme in (size, size + 1):
        groups = _class_count(scheme, similarity)
        prefix = max(0, n - least + 1 + groups - alone)
        t, frequent = tokens[:prefix], df[:prefix] > rare
        keys.append(_mix(t[~frequent]))
        t = t[frequent]
        cls = _mix(t ^ _U(0x8EBC6AF09C88C6E3)) % _U(groups)
        by = np.argsort(cls, kind="stable")
        t, cls = t[by], cls[by]
        gap = 1
        while len(t) > gap:  # tokens that are gap apart in the list of their class
            same = cls[gap:] == cls[:-gap]
            if not same.any():
                break
            a, b = t[:-gap][same], t[gap:][same]
            keys.append(_mix(np.minimum(a, b) * _U(0xE7037ED1A0B428DB) + _mix(np.maximum(a, b)) + _U(scheme)))
            gap += 1
    return np.unique(np.concatenate(keys))


# rep: the number of a set, unique over chunks; first: the smallest id that has it.
_SETS = ("rep long, first long, n int, h1 long, h2 long, ids array<long>, keys array<long>, tokens binary, "
         "hashes array<long>, bits array<long>")
_SETS_ARROW = pa.schema([("rep", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
                         ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("tokens", pa.binary()),
                         ("hashes", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])


def _gather(similarity: float, rare: int):
    """Of one chunk: a row for each set, with its index keys and shared tokens if it can have a partner."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        about = next(r for r in rows if r["ids"] is not None)
        blobs = [(r["blob"], len(r["blob"]) // 14) for r in rows if r["ids"] is None]
        tokens = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in blobs] or [np.empty(0, np.uint64)])
        df = np.concatenate([np.frombuffer(b, np.uint32, n, 8 * n) for b, n in blobs] or [np.empty(0, np.uint32)])
        owner = np.concatenate([np.frombuffer(b, np.uint16, n, 12 * n) for b, n in blobs] or [np.empty(0, np.uint16)])
        order = np.lexsort((tokens, owner))
        tokens, df, owner = tokens[order], df[order], owner[order]
        sizes = about["sizes"]
        cuts = np.searchsorted(owner, np.arange(len(sizes) + 1))
        marks = np.array(about["marks"], np.int64).reshape(-1, 10)
        members: list[list] = [[] for _ in sizes]
        for doc, ord_ in zip(about["ids"], about["ords"]):
            members[ord_].append(doc)
        out = []
        for i, n in enumerate(sizes):
            t = tokens[cuts[i]:cuts[i + 1]]
            keys = index_keys(t, df[cuts[i]:cuts[i + 1]], n, similarity, rare)
            first = min((m for m in members[i] if m is not None), default=None)
            row = (about["chunk"] << 16 | i, first, n, int(marks[i, 0]), int(marks[i, 1]), members[i])
            if len(keys):
                mins = [int(_mix(t ^ _U(s * 0x2545F4914F6CDD1D % (1 << 64))).min().view(np.int64)) for s in (1, 2, 3)]
                out.append((*row, keys.view(np.int64), t.tobytes(), mins, marks[i, 2:]))
            else:
                out.append((*row, None, None, None, None))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _SETS_ARROW)], schema=_SETS_ARROW)

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (na, nb, ta, tb) in enumerate(zip(*(batch.column(c) for c in range(2, 6)))):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (ta, tb))
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= similarity * (na.as_py() + nb.as_py() - both) - 1e-9:
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def _compare(similarity: float):
    """Of two blocks of sets: each linked set with the smallest one it is connected to in the pair of blocks."""

    def run(table: pa.Table) -> pa.Table:
        rep, n = np.asarray(table["rep"]), np.asarray(table["n"]).astype(np.float64)
        second = np.asarray(table["second"]).astype(bool)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["tokens"]]
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
        if not len(left):  # no set fell into the first block
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not len(right):
            right = left  # a block with itself
        flat = [(np.concatenate([sets[i] for i in side]), np.repeat(np.arange(len(side)), [len(sets[i]) for i in side])) for side in (left, right)]
        shared = np.intersect1d(flat[0][0], flat[1][0])
        both = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, len(shared), _COLUMNS):
            some = shared[at:at + _COLUMNS]
            x = []
            for (tokens, owner), side in zip(flat, (left, right)):
                place = np.minimum(np.searchsorted(some, tokens), len(some) - 1)
                hit = some[place] == tokens
                m = np.zeros((len(side), len(some)), np.float32)
                m[owner[hit], place[hit]] = 1
                x.append(m)
            both += x[0] @ x[1].T
        hits = both >= similarity * (n[left][:, None] + n[right][None, :] - both) - 1e-6
        root = np.arange(len(rep))
        for i in np.flatnonzero(hits.any(axis=1)):
            roots = np.unique(np.append(root[right[hits[i]]], root[left[i]]))
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[np.argmin(rep[roots])]
        at = np.flatnonzero(rep[root] != rep)
        return pa.table({"a": pa.array(rep[at]), "b": pa.array(rep[root[at]])})

    return run


def _block_links(many: DataFrame, active: DataFrame, similarity: float) -> DataFrame:
    """Links that connect sets of different groups under keys that many sets have, by blocks of sets.

    ``many(key, rep, comp, leader)`` has the smallest set of each key as its
    leader.  Sets come together under their anchor, the smallest leader of their
    keys, so that those that share keys mostly share blocks.  An anchor's sets of
    its largest group, which need no check among themselves, get blocks of their
    own.  Pairs of blocks whose anchors share a key are compared as matrices.
    """
    # Sums are written before they are joined, so that the sets of one anchor or key can be split over tasks.
    at = materialise(many.groupBy("rep", "comp").agg(F.min("leader").alias("anchor")), "ngram-anchors")
    main = (at.groupBy("anchor", "comp").agg(F.count("*").alias("m")).groupBy("anchor")
            .agg(F.max(F.struct("m", "comp")).alias("top")).select("anchor", F.col("top.comp").alias("top")))
    main = materialise(main, "ngram-main")
    at = at.join(main, "anchor").withColumn("main", F.col("comp") == F.col("top")).drop("top", "comp")
    blocks = at.groupBy("anchor", "main").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("slots"))
    blocks = materialise(blocks, "ngram-blocks")
    at = at.join(blocks, ["anchor", "main"]).withColumn("slot", F.pmod(F.xxhash64("rep"), F.col("slots")).cast("int"))
    at = materialise(at.select("rep", F.xxhash64("anchor", "main", "slot").alias("block")), "ngram-at")

    met = many.join(many.groupBy("rep").agg(F.min("leader").alias("anchor")), "rep").select("key", "anchor").distinct()
    met = met.select("key", F.col("anchor").alias("x")).join(met.select("key", F.col("anchor").alias("y")), "key").where("x <= y").select("x", "y").distinct()
    each = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    each = each.select("anchor", "main", F.xxhash64("anchor", "main", "slot").alias("block"))
    side = lambda anchor, name: each.select(F.col("anchor").alias(anchor), F.col("main").alias(f"m{name}"), F.col("block").alias(name))
    pairs = met.join(side("x", "first"), "x").join(side("y", "second"), "y")
    pairs = pairs.where("x < y or (first <= second and not (mfirst and msecond))")
    pairs = materialise(pairs.select("first", "second", F.xxhash64("first", "second").alias("pair")).distinct(), "ngram-pairs")

    members = lambda name: at.withColumnRenamed("block", name)
    rows = (pairs.join(members("first"), "first").select("pair", "rep", F.lit(False).alias("second"))
            .unionByName(pairs.where("first <> second").join(members("second"), "second").select("pair", "rep", F.lit(True).alias("second"))))
    rows = rows.join(active.select("rep", "n", "tokens"), "rep")
    return materialise(rows.groupBy("pair").applyInArrow(_compare(similarity), "a long, b long"), "ngram-block-links")


def ngram_groups(docs: DataFrame, similarity: float = 0.75, width: int = 5, rare: int = 64, few_sets: int = 16,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A set holds the distinct ``width``-word n-grams of the whole text (lower
    case for A-Z, words split at ASCII white space); a shorter text is one
    n-gram; null, empty and blank texts have the empty set and link with
    nothing.  Documents link when their Jaccard similarity is ``similarity`` or
    more; component_id is the smallest id reachable, the own id without links.
    Rows are linked by their texts: a row of null id links like any other and
    has a null component, and rows that repeat an id are documents of their
    own, grouped each by its text.  An empty table gives no rows.  Ids are
    whole numbers.  ``docs`` must be a deterministic input (files).
    ``similarity`` must be above 2/3: only then do sets of one or two n-grams
    link to equal sets alone, on which ``index_keys`` relies.
    """
    found = _grouped_sets(docs, similarity, width, rare, few_sets, id_col, text_col)
    found = found.select("n", "least", F.explode("ids").alias("doc_id"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("least"))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def _grouped_sets(docs: DataFrame, similarity: float, width: int, rare: int, few_sets: int, id_col: str, text_col: str) -> DataFrame:
    """A row for each set of each chunk: ``first, n, h1, h2, ids``, its ``component`` and the ``least`` id of that."""
    if not 2 / 3 < similarity <= 1:
        raise ValueError(f"similarity must be above 2/3 and at most 1, not {similarity}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(16, max(8, math.ceil(math.log2(4 * parts))))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.mapInArrow(_spread(width, bits), _MAP)
    counted = dealt.groupBy("p").applyInArrow(_count(bits), _MAP)
    sets = materialise(counted.groupBy("chunk").applyInArrow(_gather(similarity, rare), _SETS), "ngram-sets")

    canon = sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("rep").alias("canon"))
    canon = materialise(canon, "ngram-canon")
    active = sets.where("keys is not null").join(canon.select(F.col("canon").alias("rep")).distinct(), "rep", "left_semi")
    active = active.select("rep", "n", "keys", "tokens", "hashes", *[F.col("bits")[i].alias(f"b{i}") for i in range(8)])
    active = materialise(active, "ngram-active")
    narrow = active.select("rep", "n", *[f"b{i}" for i in range(8)])

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        side = lambda x: narrow.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), *[F.col(f"b{i}").alias(f"{x}{i}") for i in range(8)])
        differ = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(8)), F.lit(0))
        both = (1 - similarity) / (1 + similarity)  # of both sizes, the share of tokens in one set only
        pairs = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9)
                 .where(differ <= both * (F.col("na") + F.col("nb")) + 1e-9).select("a", "b", "na", "nb"))
        text = lambda x: active.select(F.col("rep").alias(x), F.col("tokens").alias(f"t{x}"))
        full = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "na", "nb", "ta", "tb")
        return materialise(full.mapInArrow(_verify(similarity), "a long, b long"), "ngram-links")

    def labelled(links: DataFrame, what: DataFrame) -> DataFrame:
        comp = materialise(components(links), "ngram-components")
        return (what.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("comp", F.coalesce("component", "rep")).drop("component"))

    # Round 1: sets that share a min-hash, each with the smallest of them.
    hashed = active.select("rep", F.explode("hashes").alias("key"))
    first = hashed.groupBy("key").agg(F.min("rep").alias("b"), F.count("*").alias("m")).where("m > 1").drop("m")
    first = materialise(first, "ngram-first")
    links = links_of(hashed.join(first, "key").select(F.col("rep").alias("a"), "b"))

    # Round 2: of each key with sets of several groups, every set with the smallest one.
    def live(links: DataFrame, keyed: DataFrame) -> DataFrame:
        keyed = labelled(links, keyed)
        if "keys" in keyed.columns:
            keyed = keyed.select("rep", "comp", F.explode("keys").alias("key"))
        split = keyed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        return materialise(keyed.join(materialise(split, "ngram-split"), "key", "left_semi"), "ngram-live")

    open_keys = live(links, active.select("rep", "keys"))
    leader = materialise(open_keys.groupBy("key").agg(F.min(F.struct("comp", "rep")).alias("first")), "ngram-leader")
    more = links_of(open_keys.join(leader, "key").where("comp <> first.comp").select(F.col("rep").alias("a"), F.col("first.rep").alias("b")))
    links = links.unionByName(more)

    # Round 3: every pair of a key that is still in different groups.
    open_keys = live(links, open_keys.select("rep", "key"))
    per_key = materialise(open_keys.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("leader")), "ngram-per-key")
    few = open_keys.join(per_key.where(F.col("m") <= few_sets).select("key"), "key", "left_semi")
    pairs = (few.select("key", F.col("rep").alias("a"), F.col("comp").alias("ca"))
             .join(few.select("key", F.col("rep").alias("b"), F.col("comp").alias("cb")), "key").where("a < b and ca <> cb").select("a", "b"))
    many = open_keys.join(per_key.where(F.col("m") > few_sets).select("key", "leader"), "key")
    links = links.unionByName(links_of(pairs)).unionByName(_block_links(materialise(many, "ngram-many"), active, similarity))

    comp = components(links).withColumnRenamed("node", "canon")
    class_of = canon.join(comp, "canon", "left").select("h1", "h2", "n", F.coalesce("component", "canon").alias("component"))
    named = sets.select("first", "h1", "h2", "n", "ids").join(class_of, ["h1", "h2", "n"], "left")
    named = materialise(named, "ngram-named")
    # Written first, so that the sets of one large component can be split where they are joined to it.
    least = materialise(named.where("n > 0").groupBy("component").agg(F.min("first").alias("least")), "ngram-least")
    return named.join(least, "component", "left")


def _hash_rows(width: int, schema: pa.Schema, text_col: str):
    """Rows with the size and the two numbers of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column(batch.schema.get_field_index(text_col))]
            names = np.array([_identity(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            more = [pa.array([len(s) for s in sets], pa.int32()), pa.array(names[:, 0]), pa.array(names[:, 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema=schema)

    return run


def drop_near_copies(docs: DataFrame, similarity: float = 0.75, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of texts that are linked, over any number of steps: the one of smallest id.

    Rows are decided by their texts: of rows that repeat an id, each stays or
    goes with its own group, and of rows that repeat id and set one stays.  Any
    id is smaller than null; in a group of null ids alone one row stays.  Texts
    without words are linked with nothing and stay.  Ids are whole numbers;
    other columns may have any name.
    """
    sets = _grouped_sets(docs, similarity, width, 64, 16, id_col, text_col)
    order = F.struct(F.col("first").isNull(), "first", "h1", "h2")
    stays = sets.where("n > 0").groupBy("component").agg(F.min(order).alias("w"))
    stays = materialise(stays.select("component", F.col("w.first").alias("win_id"), F.col("w.h1").alias("win_h1"), F.col("w.h2").alias("win_h2")), "ngram-stays")
    wins = F.col("first").eqNullSafe(F.col("win_id")) & (F.col("h1") == F.col("win_h1")) & (F.col("h2") == F.col("win_h2"))
    rows = sets.drop("least").join(stays, "component", "left")
    rows = rows.select(F.explode("ids").alias("id"), "h1", "h2", "n", "win_id", (wins | (F.col("n") == 0)).alias("wins"))
    rows = rows.withColumn("wins", F.col("wins") & ((F.col("n") == 0) | F.col("id").eqNullSafe(F.col("win_id"))))
    rows = materialise(rows.drop("win_id"), "ngram-rows")
    # An id that comes once is decided by itself; rows of the others, and of null ids, are hashed again.
    again = materialise(rows.where("id is not null").groupBy("id").agg(F.count("*").alias("m")).where("m > 1").select("id"), "ngram-again")
    nulls = rows.where("id is null").limit(1).count()
    several = nulls or again.limit(1).count()
    prefix = _free_prefix(docs)
    key = F.col(_quoted(id_col)).cast("long")
    lost = rows.where("not wins").join(again, "id", "left_anti").select(F.col("id").alias(f"{prefix}gone")).where(F.col(f"{prefix}gone").isNotNull())
    if not several:
        return docs.join(lost, key == F.col(f"{prefix}gone"), "left_anti")
    repeated = again.select(F.col("id").alias(f"{prefix}again"))
    once = docs.where(key.isNotNull()).join(repeated, key == F.col(f"{prefix}again"), "left_anti").join(lost, key == F.col(f"{prefix}gone"), "left_anti")
    more = docs.where(key.isNotNull()).join(repeated, key == F.col(f"{prefix}again"), "left_semi").unionByName(docs.where(key.isNull()))
    names = [f"{prefix}{x}" for x in ("n", "h1", "h2")]
    schema = more.schema
    for name, kind in zip(names, (T.IntegerType(), T.LongType(), T.LongType())):
        schema = T.StructType([*schema.fields, T.StructField(name, kind)])
    hashed = more.mapInArrow(_hash_rows(width, to_arrow_schema(schema), text_col), schema)
    blank = hashed.where(F.col(names[0]) == 0)
    worded = hashed.where(F.col(names[0]) > 0).dropDuplicates([id_col, *names])
    kept = rows.where("wins and n > 0").select(F.col("id").alias(f"{prefix}id"), *[F.col(x).alias(f"{y}w") for x, y in zip(("n", "h1", "h2"), names)]).distinct()
    same = key.eqNullSafe(F.col(f"{prefix}id"))
    for name in names:
        same = same & (F.col(name) == F.col(f"{name}w"))
    return once.unionByName(worded.join(kept, same, "left_semi").unionByName(blank).drop(*names))


def _free_prefix(docs: DataFrame) -> str:
    """A prefix that none of the columns has."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix + "x_"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
