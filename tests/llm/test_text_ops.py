"""Classifiers, page text, archives and piece sampling."""
import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import html_diff, line_crf, piece_sampling, toxicity, warc_chunks
from wardline.llm.labelled import training_sample

DOCS = "doc_id long, text string, extra int"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["an", "ti", "re", "shon", "bel", "ou"]) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(900):
        toxic, good = i % 4 == 0, i % 3 != 0
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = [word() for _ in range(rng.randint(5, 20))]
            if toxic:
                words.insert(rng.randrange(len(words)), rng.choice(["grobnik", "zarkwit", "flumpox"]))
            line = " ".join(words).capitalize() + "."
            lines.append(line if good else " ".join(w.upper() + "!!" for w in line.split()))
        rows.append((i, "\n".join(lines), 1))
        labels.append((i, int(good), int(toxic)))
    rows += [(2000, None, 1), (2001, "", 1), (2002, " \n", 1), (2003, "tire an " * 40_000, 1), (None, "an ti", 1), (5, rows[5][1], 1)]
    labels += [(2000, 1, None), (None, 1, 1), (7, None, None)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_training_sample_is_bounded(labelled):
    docs, labels = labelled
    got = training_sample(docs, labels, "toxic", F.lit(False), 20, 2000)
    assert Counter(y for _, y in got) == {0: 20, 1: 20}


def test_toxicity(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, model).collect()}
    held = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).where("toxic is not null")
    right = [(scores[r["doc_id"]] >= 0.5) == bool(r["toxic"]) for r in held.collect()]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert scores[2000] == scores[2001] < 0.5 and scores[2003] < 0.5 and all(0 <= s <= 1 for s in scores.values())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for r in docs.collect() if scores[r["doc_id"]] < 0.5)
    assert toxicity.toxicity_scores(docs.limit(0), model).count() == 0
    alone = toxicity.train(docs, labels.where("toxic = 0"))  # one label only: its rate for all
    assert {round(r["score"], 6) for r in toxicity.toxicity_scores(docs.limit(3), alone).collect()}.__len__() == 1
    assert toxicity.train(docs.limit(0), labels.limit(0)).weights[0] == 0


def test_quality(labelled):
    docs, labels = labelled
    model = line_crf.train(docs, labels)
    got = line_crf.quality_scores(docs, model).collect()
    scores = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    held = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).where("quality is not null")
    right = [(scores[r["doc_id"]] >= 0.7) == bool(r["quality"]) for r in held.collect()]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert line_crf.quality_scores(docs.limit(0), model).count() == 0
    assert line_crf.train(docs.limit(0), labels).scores([[b"x"]]).shape == (1,)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4, 2])
    emit, trans = rng.normal(size=10), rng.normal(size=(2, 2))
    good, pairs, z = line_crf.marginals(emit, lengths, trans)
    want, at, total, both = [], 0, 0.0, np.zeros((2, 2))
    for n in lengths:
        weights = {}
        for code in range(2 ** n):
            y = [(code >> i) & 1 for i in range(n)]
            weights[tuple(y)] = np.exp(sum(emit[at + i] for i in range(n) if y[i]) + sum(trans[a, b] for a, b in zip(y, y[1:])))
        s = sum(weights.values())
        total += np.log(s)
        want += [sum(w for y, w in weights.items() if y[i]) / s for i in range(n)]
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                both[a, b] += w / s
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, both) and np.isclose(z, total)


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li>Menu</ul></nav><!-- <p>no</p> --><div class='ad-box'>Buy</div><article id='x'><h1>Head &amp; l&#105;ne</h1>"
        "<p><b>Bold</b>er &lt;text&gt;<br>next\n  line<p>Two<div class=\"share\">Share</div><form>f<input></form><section id=comments><p>Me!</p></section>"
        "<aside>s</aside></article><footer>&copy;</footer></body></html>")


def test_page_text(spark):
    assert " ".join(t for t, _ in html_diff.text_blocks(PAGE)) == "Head & line Bolder <text> next line Two"
    wrapped = ("<body class=has-sidebar><div class='page with-sidebar'><main><article class='post'><p>Kept</p><article class='comment'>no</article>"
               "<div class=notice>n</div><div class='sidebar'>s<article>inner</article></div></article><p>Related</p></main></div></body>")
    assert html_diff.main_text(html_diff.text_blocks(wrapped), None) == "Kept"
    plain = "<html><body><div>Site name</div><div>{}</div><p>Read on</p><div>Imprint</div></body></html>"
    rows = [(1, "http://h.x/a/1", PAGE), (2, "http://h.x/b/1?q", plain.format("One story")), (3, "http://h.x/b/2#t", plain.format("Another story")),
            (4, "http://alone.x/", plain.format("Only")), (5, None, None), (6, "http://h.x/c", ""), (7, "http://h.x/z/1?q", "<p>" + "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int").coalesce(1)
    got = {r["page_id"]: r for r in html_diff.extract_main_text(df).collect()}
    texts = {k: r["text"] for k, r in got.items()}
    assert texts[1] == "Head & line Bolder <text> next line Two" and texts[3] == "Another story"
    assert texts[4] == "Site name Only Read on Imprint" and texts[5] == texts[6] == "" and len(texts[7]) == 249_999
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_diff.extract_main_text(df.limit(0)).count() == 0


STORY = "<body><div>Site name and menu</div><p>{}</p><p>{}</p><div>Imprint</div></body>"


def page_texts(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in html_diff.extract_main_text(df).orderBy("page_id").collect()]


def test_copies_are_no_partners(spark):
    long = " ".join(f"word{i}" for i in range(80))
    same = STORY.format(long, "end")
    assert page_texts(spark, [("http://two.x/p?a=1", same), ("http://two.x/p?a=2", same)]) == ["Site name and menu " + long + " end Imprint"] * 2
    rows = [("http://h.x/a?a=1", same), ("http://h.x/a?a=2", same), ("http://h.x/a?a=3", STORY.format(long, "fin")), ("http://h.x/b", STORY.format("Other story", "of its own"))]
    assert page_texts(spark, rows) == [long + " end", long + " end", long + " fin", "Other story of its own"]
    assert html_diff.main_text([("x", 0), ("y", 0)], [("x", 0), ("y", 0)]) == "x y"


def test_pages_at_the_edges_of_ranges_have_partners(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(rng.choice("abcdefgh") * 5 for _ in range(n))
    rows = []
    for i in range(40):
        body = STORY.format(words(20), words(9))
        rows += [(f"http://{'g' if i < 9 else 'h'}.x/{i // 4:02}/{i}", body)] * (12 if i in (3, 30) else 1)
    want = [html_diff.text_blocks(h) for _, h in rows]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 13):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert page_texts(spark, rows) == [" ".join(t for t, _ in b[1:3]) for b in want], n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_teasers_are_not_the_main_text(spark):
    long = "A long story that stands beside its teaser. " * 5
    page = "<body><div>Menu {0}</div><{1}><p>" + long + "{0}</p><article>Teaser card</article></{1}><p>Shared line</p></body>"
    texts = page_texts(spark, [(f"http://t.x/{i}", page.format(i, tag)) for i, tag in enumerate(["main", "main", "div", "div"])])
    assert all(f"{long}{i} Teaser card" in t and "Shared line" not in t for i, t in enumerate(texts)), texts


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(html_diff.shared_lines(a, b))
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found)


def test_shared_lines_of_long_pages_in_parts(monkeypatch):
    rng = random.Random(4)
    whole = []
    for cells in (1 << 21, 6):
        monkeypatch.setattr(html_diff, "LCS_CELLS", cells)
        rng.seed(4)
        sizes = []
        for _ in range(200):
            a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 30))] for _ in range(2))
            found, rest = sorted(html_diff.shared_lines(a, b)), iter(b)
            assert all(a[i] in rest for i in found)
            sizes.append(len(found))
        whole.append(sizes)
    assert whole[0] == whole[1]
    monkeypatch.undo()
    lines = [str(rng.randrange(20_000)) for _ in range(20_000)]
    a, b = ([x if rng.random() < 0.7 else f"z{rng.randrange(3000)}" for x in lines] for _ in range(2))
    tracemalloc.start()
    found, rest = sorted(html_diff.shared_lines(a, b)), iter(b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    same = sum(x == y for x, y in zip(a, b))
    assert len(found) >= same and all(a[i] in rest for i in found)
    assert peak < 60 << 20  # a table of all lengths would take 1,600 MB


def test_chunks_of_a_long_payload(spark):
    long = "".join("a€😀\n"[i % 4] * (i % 3 + 1) for i in range(40_000))
    rows = [(1, "u", long, None), (2, "u", "x" * 1000, None), (3, "u", "x" * 1001, None), (4, "u", "", None), (5, "u", long, 1)]
    plan = spark.createDataFrame([(i, u, t, len(t.encode()), "d", r) for i, u, t, r in rows],
                                 "page_id long, url string, payload string, bytes long, digest string, refers_to long")
    broken = plan.where("page_id = 3").select(F.lit(6).cast("long").alias("page_id"), "url",
                                              F.concat(F.unhex(F.lit("ff")).cast("string"), "payload").alias("payload"), "bytes", "digest", "refers_to")
    got: dict = {}
    for r in warc_chunks.record_texts(plan.unionByName(broken), chunk_chars=1000).select(F.col("value").cast("binary")).collect():
        head, _, block = bytes(r[0]).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert int(fields["Content-Length"]) == len(block)
        page = int(fields["WARC-Record-ID"].strip("<>").split("page:")[1].split(":")[0])
        got.setdefault(page, []).append((int(fields.get("WARC-Segment-Number", 1)), block))
    whole = {i: b"".join(b for _, b in sorted(parts)).partition(b"\r\n\r\n")[2] for i, parts in got.items()}
    assert [whole[i] for i in (1, 2, 3, 4, 5, 6)] == [long.encode(), b"x" * 1000, b"x" * 1001, b"", b"", b"\xff" + b"x" * 1001]
    assert [len(got[i]) for i in (1, 2, 3, 4, 5, 6)] == [-(-len(long) // 1000), 1, 2, 1, 1, 2]


def test_archives(spark, workdir):
    rows = [(1, "u", "a" * 2000), (2, "v", "a" * 2000), (3, None, None), (4, "x", "abc\r\n"), (5, "x\r\ny", "\r\n\r\nabc\r\n\r\n"), (6, "x", "\r\n"),
            (7, "x", "\r\n\r"), (8, "x", "é\r\n\r\n\r\n"), (None, "x", "WARC/1.1\r\n\r\n"), (9, "big", "xy\r\n\r\n€" * 1000),
            (10, "y", "\r\n\r\n" * 300), (11, "z", "s" * 999), (12, "z", "s" * 999)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    path = f"{workdir}/archives"
    warc_chunks.write_archives(pages, path, chunk_chars=777)
    got = {r["page_id"]: r for r in warc_chunks.read_records(spark, path).collect()}
    chunks = warc_chunks.read_chunks(spark, path).collect()
    assert len(got) == len(rows) and max(len(r["payload"]) for r in chunks) < 4 * 777
    for i, url, html in rows:
        data, r = (html or "").encode(), got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest()), i
        assert r["url"] == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
        mine = sorted((c for c in chunks if c["page_id"] == i), key=lambda c: c["chunk"])
        if r["record_type"] == "response":
            assert b"".join(bytes(c["payload"]) for c in mine) == data
            so_far = b""
            for c in mine:  # digests run along
                so_far += bytes(c["payload"])
                assert c["payload_digest"] == hashlib.sha1(so_far).hexdigest()
    assert [(i, r["refers_to"]) for i, r in got.items() if r["record_type"] == "revisit"] == [(1, 2)]
    warc_chunks.write_archives(pages.limit(0), path + "0")
    assert warc_chunks.read_records(spark, path + "0").count() == 0


def test_piece_sampling(spark):
    texts = ["Hello world", " a  b   c ", "", "x▁y ▁", chr(0xE000F) + "z\U0001F600é漢字 \t\n\n q", "a\n\0sign", None, "the " * 9000, "b" * 5000, "▁"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "no key", 1), (0, texts[0], 1)], "doc_id long, text string, ids int")
    got = piece_sampling.sample_pieces(df, check=True)
    rows = got.collect()
    assert all(r["lossless"] for r in rows) and len(rows) == len(texts) + 2
    again = piece_sampling.sample_pieces(df.repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["ids"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    back = {r["doc_id"]: r["text"] for r in piece_sampling.decode_pieces(got.where("doc_id is not null")).collect()}
    assert back == dict(enumerate(texts))
    other = piece_sampling.sample_pieces(df, seed=8).where("doc_id = 7").first()["ids"]
    assert other != next(r["ids"] for r in rows if r["doc_id"] == 7)
    assert piece_sampling.sample_pieces(df.limit(0)).count() == 0


def test_samples_follow_the_lattice_probabilities():
    vocab = piece_sampling.vocabulary(piece_sampling.DEFAULT_MODEL, 1.0)
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_sampling.DEFAULT_MODEL)
    ids = {sp.id_to_piece(i): i for i in range(259, sp.get_piece_size())}
    score = dict(zip(vocab.piece.tolist(), vocab.score.tolist()))

    def paths(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in ids:
                for rest, x in paths(s[n:]):
                    yield (ids[s[:n]], *rest), x + score[ids[s[:n]]]

    want = {p: np.exp(x) for p, x in paths("▁inoning")}
    total, n = sum(want.values()), 30_000
    got = Counter(tuple(x.tolist()) for x in piece_sampling.encode(["inoning"] * n, [piece_sampling._key(i, 1) for i in range(n)], vocab))
    assert set(got) <= set(want)
    assert max(abs(got[p] / n - w / total) for p, w in want.items()) < 0.012


def test_pieces_of_a_batch_of_nulls(spark):
    df = spark.createDataFrame([(i, None) for i in range(3)], "doc_id long, text string").coalesce(1)
    assert [tuple(r) for r in piece_sampling.sample_pieces(df, check=True).collect()] == [(i, None, 0, True) for i in range(3)]


def test_words_of_a_batch_are_filtered_once(monkeypatch):
    """op6: a lattice takes each distinct word once, and prefixes are found in a hash index."""
    vocab, seen = piece_sampling.vocabulary(piece_sampling.DEFAULT_MODEL, 1.0), []
    made = piece_sampling._Lattice
    monkeypatch.setattr(piece_sampling, "_Lattice", lambda v, words: seen.append(list(words)) or made(v, words))
    texts = ["a bb a", "bb ▁ a", "", "x" * 70_000]
    ids = piece_sampling.encode(texts, [1, 2, 3, 4], vocab)
    assert [piece_sampling.decode(x, vocab) for x in ids] == texts
    assert all(len(w) == len(set(w)) for w in seen) and seen and vocab.prefixes.is_unique
