"""Quality rules and the Kneser-Ney model against plain restatements."""
import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardline.llm import perplexity_rules as pr

DOCS = "doc_id long, text string, lang string"


def rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def discounts(counts):
    n = [sum(c == i for c in counts.values()) for i in range(5)]
    if all(n[1:]):
        y = n[1] / (n[1] + 2 * n[2])
        d = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
        if all(0 <= x <= i + 1 for i, x in enumerate(d)):
            return d
    return [0.5, 1.0, 1.5]


def model(texts):
    """log probability of each 4-gram of the texts, by the recursion as it stands in the literature."""
    seqs = [["START"] * 3 + list(t) + ["END"] for t in texts]
    counts = {4: Counter(tuple(s[i:i + 4]) for s in seqs for i in range(len(s) - 3))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: discounts(c) for k, c in counts.items()}
    cut = lambda k, c: d[k][min(c, 3) - 1]
    after = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            after[k][g[:-1]].append(n)

    def p(g):
        k = len(g)
        if not k:
            return 1 / len(counts[1])
        ns = after[k][g[:-1]]
        return (counts[k][g] - cut(k, counts[k][g]) + sum(cut(k, n) for n in ns) * p(g[1:])) / sum(ns)

    return {g: math.log(p(g)) for g in counts[4]}


def quartile(scores, share):
    bins = sorted(math.floor(1000 * s) for s in scores)
    return next(b for i, b in enumerate(bins) if i + 1 >= share * len(bins)) / 1000


def restated(rows, low=8.0, high=12.0, least=0.02):
    norm = lambda t: " ".join(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    score = {}
    for lang in {r[2] for r in rows}:
        texts = [norm(t) for _, t, l in rows if l == lang and norm(t)]
        logs = model(texts)
        for t in set(texts):
            s = ["START"] * 3 + list(t) + ["END"]
            score[lang, t] = -sum(logs[tuple(s[i:i + 4])] for i in range(len(s) - 3)) / (len(s) - 3)
    bands = {}
    for lang in {l for l, _ in score}:
        q1, q3 = (quartile([v for (l, _), v in score.items() if l == lang], x) for x in (0.25, 0.75))
        bands[lang] = (q1 - low * max(q3 - q1, least), q3 + high * max(q3 - q1, least))
    out = []
    for i, t, lang in rows:
        r = rules(t or "")
        bad = r[0] < 20 or 100 * r[4] > 30 * r[0]
        s = score.get((lang, norm(t)))
        out.append((i, *r, bad, not bad and bands[lang][0] <= s <= bands[lang][1], None if s is None else round(s, 4)))
    return sorted(out, key=str)


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ü中"[:6 + i % 3]) for _ in range(rng.randint(1, 6))).strip() or "a" for i in range(150)]
    text = lambda n: "".join(rng.choice(words) + rng.choice("    \n\t") for _ in range(n))
    rows = [(i, text(rng.randint(1, 120)), rng.choice(["en", "en", "de", None])) for i in range(160)]
    rows += [(200 + i, "same line here\n" * 4 + text(30), "en") for i in range(4)]
    rows += [(300, None, "en"), (301, "", "xx"), (302, " \n\t ", "de"), (303, "one", "lone"), (304, "##$%&|<>* a\r\n#", "de")]
    rows += [(310, "".join(rng.choice("QWXZJK!?%") for _ in range(400)) + " a b" * 30, "en"), (311, "aaaa " * 400, "en"), (None, text(40), "en")]
    return rows + [(400 + i, rows[3][1], "en") for i in range(60)] + [rows[5], rows[5]]


def test_equals_restatement(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("x")).withColumn("symbols", F.lit(0)).withColumn("rest", F.lit(0))
    shown = lambda df: sorted(((*r[:8], None if r[8] is None else round(r[8], 4)) for r in df.collect()), key=str)
    got = shown(pr.perplexity_rules(docs))
    assert got == restated(rows)
    got = shown(pr.perplexity_rules(docs, low=1.0, high=0.5))
    assert got == restated(rows, 1.0, 0.5)
    assert any(not r[6] and not r[7] for r in got) and any(r[7] for r in got) and any(r[6] for r in got)


def test_bounds_change_nothing(spark, monkeypatch):
    """Chunks, pieces and shards of a few rows: the same scores."""
    docs = spark.createDataFrame(corpus(6), DOCS)
    want = sorted(map(str, pr.perplexity_rules(docs).collect()))
    monkeypatch.setattr(pr, "SHARD", 100)
    assert sorted(map(str, pr.perplexity_rules(docs.coalesce(1), chunk_chars=3000).collect())) == want


def test_edges(spark):
    assert pr.perplexity_rules(spark.createDataFrame([], DOCS)).collect() == []
    only = pr.perplexity_rules(spark.createDataFrame([(1, None, None), (2, " ", "x")], DOCS)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["base_failed"], r["kept"], r["log_perplexity"]) for r in only) == [(1, 0, True, False, None), (2, 0, True, False, None)]
    text = " ".join(f"w{i % 977}é" for i in range(400_000))
    long = pr.perplexity_rules(spark.createDataFrame([("a", text, "x"), ("b", text[:5000], "x")], "doc_id string, text string, lang string")).collect()
    assert {r["doc_id"]: r["n_words"] for r in long} == {"a": 400_000, "b": len(text[:5000].split())}
    assert {r["doc_id"]: r["n_repeat_words"] for r in long}["a"] == 400_000


@pytest.mark.parametrize("text", ["a\nb\na\n a\na \n\n\nb", "x " * 8, "x " * 9, "a b c d e f g h " * 2 + "i", "   x\n   x", "A\x1cB\x85C d"])
def test_text_rules(text):
    assert pr.text_rules(text) == rules(text)


def test_pieces_are_packed_tightly():
    """The texts of a chunk travel; at the first level of compression the check tool found 1.52 x the input on disk."""
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    lines = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(2000)]
    texts = ["\n".join(rng.choice(lines) for _ in range(50)) for _ in range(200)]
    packed = sum(len(b.column(1)[0].as_py()) for b in pr._pieces(0, [(pa.scalar(i), 5, t) for i, t in enumerate(texts)]))
    assert packed < 0.95 * len(pa.Codec("zstd", 1).compress("".join(texts).encode(), asbytes=True))


@pytest.mark.parametrize("text", ["", " \n", "a\x1cb \x85c d e f", "é\tx\x0by\x0cz\r\nz", "\ud800 a"])
def test_words_are_split_at_ascii_blanks_only(text):
    assert [w.decode("utf-8", "surrogatepass") for w in pr._words(text)] == re.findall(r"[^\x20\x09-\x0D]+", text)
