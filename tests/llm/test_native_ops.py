"""Exact dedup, mixing and personal data against plain restatements."""
import hashlib
import random
import re

import brute
from pyspark.sql import functions as F

from wardline.llm.exact_dedup import drop_copies, exact_groups
from wardline.llm.mix_sources import mix, mixed_rows
from wardline.llm.pii_bootstrap import find_personal_data

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


def test_exact_groups(spark):
    rows = [(5, "a  b\t\nc", "x"), (2, "a b c", "x"), (9, " a b c", "x"), (3, None, "x"), (4, "", None), (7, "é" * 70 + "1", "x"),
            (8, "é" * 70 + "2", "x"), (6, "é" * 70 + "1", "x"), (None, "a b c", "x"), (6, "é" * 70 + "1", "x"), (11, " \n", "x"), (12, " ", "x")]
    docs = docs_of(spark, rows).withColumn("kept", F.lit(1)).withColumn("len", F.lit(2)).withColumn("n", F.lit(3))
    by: dict = {}
    for i, t, _ in rows:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = sorted(((i or 0), min(x for x in g if x is not None), len(g), i == min(x for x in g if x is not None),
                   hashlib.sha256(t.encode()).hexdigest()) for t, g in by.items() for i in g)
    full = exact_groups(docs, digest_all=True).collect()
    assert sorted((r[0] or 0, *r[1:]) for r in full) == want
    lean = exact_groups(docs).collect()  # full hashes only where length and prefix are shared
    assert sorted((r[0] or 0, r[1], r[2], r[3]) for r in lean) == [w[:4] for w in want]
    assert all(r[4] in (None, w[4]) for r, w in zip(sorted(lean, key=lambda r: (r[0] or 0)), want))
    assert sorted(r["doc_id"] for r in drop_copies(docs).collect()) == [2, 3, 6, 6, 7 + 1, 9, 11][:7]
    assert drop_copies(docs).columns == docs.columns
    assert exact_groups(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_decided_by_their_own_text(spark):
    rows = [(None, "copied text", "x"), (None, "a text of its own", "x"), (1, "copied text", "x"), (7, "first", "x"), (7, "copied text", "x"),
            (None, "only nulls", "x"), (None, "only  nulls", "y"), (None, "copied text", "y")]
    docs = docs_of(spark, rows)
    kept = sorted((str(r["doc_id"]), r["text"]) for r in drop_copies(docs).collect())
    assert kept == [("1", "copied text"), ("7", "first"), ("None", "a text of its own"), ("None", "only  nulls"), ("None", "only nulls")]
    full, lean = (sorted(map(str, (r[:4] for r in exact_groups(docs, digest_all=d).collect()))) for d in (True, False))
    assert lean == full and len(lean) == len(rows)


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(1000, None, "d"), (1001, "", "d"), (None, "x y", "b")]
    docs = docs_of(spark, rows).withColumn("size", F.lit(0)).withColumn("target", F.lit("t"))
    got = mix(docs).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs.repartition(7)).collect()), key=str)
    size: dict = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(names)
    while open_:  # hand out by weight until no source is above twice its size
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            open_.remove(s)
    for s in names:
        mine = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6 for r in mine)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(r["size"] for r in mine)
    assert len({r["copies"] for r in got if r["source"] == "a" and r["size"]}) <= 2   # whole epochs first
    rows_out = mixed_rows(docs)
    assert rows_out.columns == docs.columns
    assert rows_out.count() == sum(r["copies"] for r in got)
    assert mix(docs.limit(0)).count() == 0


def test_ties_and_empty_texts(spark):
    """Rows of one id are taken alike in any input order; an empty text is never taken more often than twice."""
    rng = random.Random(8)
    rows = [(1, " ".join(["w"] * rng.randint(1, 30)) + f" {i}", "a") for i in range(200)] + [(i, "x " * 50, "b") for i in range(40)]
    rows += [(1000 + i, rng.choice(["", None, " "]), "a") for i in range(40)] + [(2000 + i, None, "c") for i in range(5)] + [(3000, "", "tiny"), (3001, "one word", "tiny")]
    taken = []
    for i in range(2):
        rng.shuffle(rows)
        docs = docs_of(spark, rows).repartition(3 + i)
        got = mix(docs, seed=i // 2 + 1)
        assert got.agg(F.max("copies")).first()[0] <= 2
        taken.append(sorted(map(str, got.collect())))
    assert taken[0] == taken[1]
    for seed in (1, 2, 3, 4):
        assert mix(docs_of(spark, [(i, None if i % 2 else "word " * 9, "s") for i in range(30)] + [(99, "many words " * 400, "t")]), seed=seed).agg(F.max("copies")).first()[0] <= 2


def test_better_rows_are_taken_more_often(spark):
    rows = [(i, ("good words here now " if i % 2 else "bad!! ##words$$ h&&ere **now ") * 5, f"s{i % 3}") for i in range(900)]
    got = {r["doc_id"]: r["copies"] for r in mix(docs_of(spark, rows)).collect()}
    assert sum(got[i] for i in got if i % 2) > 1.1 * sum(got[i] for i in got if not i % 2)


def check_personal(got, texts):
    names = ["email", "ip", "card", "phone"]
    for r in got:
        base = brute.base_spans(texts[r["doc_id"]])
        joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in base))
        assert [r[f"n_{n}"] for n in names] == [sum(k == i for k, _, _ in base) for i in range(4)], texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_personal_data(spark):
    rng = random.Random(3)
    letters = ["ab@.-+1234567890 ()é\n_%", "0123456789.-+ @a"]
    texts = {i: "".join(rng.choice(letters[i % 2]) for _ in range(rng.randint(0, 120))) for i in range(500)}
    texts |= {1000: "1 2 " * 5000, 1001: "a.b@" * 2000 + "c.d", 1002: "9" * 20000, 1003: None, 1005: "x@a" + ".b" * 5000,
              1004: "+1 222 333 4444 4444-4444-4444-4448 4111 1111 1111 1111"}
    for i in range(8):  # a key that leads to cards, and to a number that is none
        texts[2000 + i] = f"my card={'4111 1111 1111 1111' if i < 6 else '7731-9920-55'} thanks"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("row", F.lit(2))
    got = find_personal_data(docs, confidence=0.7).collect()
    assert len(got) == len(texts)
    check_personal(got, texts)
    added = {r["doc_id"]: r["spans"] for r in got if r["doc_id"] >= 2006}
    at = texts[2006].index("7731")
    assert all(f"id:{at}:{at + 12}" in s.split(",") for s in added.values()), added
    assert find_personal_data(docs.limit(0)).count() == 0


def test_secrets_are_discovered(spark):
    rng = random.Random(5)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 2)) + "7a"
    long_word = "x" * 300
    texts = {i: f"pay with {4111111111111111} or 4012888888881881 now" for i in range(6)}
    texts |= {100 + i: f'he wrote token = "{hexa(40)}" there' for i in range(5)}
    texts |= {200 + i: f"so password={hexa(18)}, then" for i in range(5)}
    texts |= {300 + i: f"{long_word}{'ab'[i % 2]}: KEYS{hexa(16).upper()} ok" for i in range(6)}
    texts |= {400 + i: f"Version 2.0 of 20{10 + i}, page {i}, about 31415{i} items" for i in range(6)}
    got = {r["doc_id"]: r for r in find_personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i, t in texts.items():
        at = re.search(r'(?<=")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}|KEYS[0-9A-F]{16}', t)
        want = [f"id:{at.start()}:{at.end()}"] if at else []
        assert [s for s in got[i]["spans"].split(",") if s.startswith("id:")] == want, (t, got[i]["spans"])
        assert got[i]["n_added"] == len(want) and got[i]["n_spans"] == len(list(filter(None, got[i]["spans"].split(","))))


def test_hashes_without_seeds_are_left(spark):
    texts = [(i, f"commit: {hashlib.sha1(str(i).encode()).hexdigest()} by me") for i in range(20)]
    got = find_personal_data(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert all(r["spans"] == "" and r["n_spans"] == 0 for r in got)
