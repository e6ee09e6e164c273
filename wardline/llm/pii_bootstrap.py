"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Base entities (email, ip, card, phone) are found by regular expressions, with
code point spans.  They seed a pattern-instance graph: an instance is a token
with digits or an at sign, a pattern is the words or the key in front of it, or
the letters it begins with.  Instances of one coarse shape share a node, too,
so that scores reach patterns behind which no base entity stands.
Scores are passed between patterns, shapes and instances for some rounds;
instances behind confident patterns that no base entity covers are added as
``id`` spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import SPACES, materialise

# The kinds in listing order.  The patterns equal the contract's; a match can only begin where the run of
# characters that it starts with begins (or the last match ended), and runs are possessive, so that long runs are read once.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_KEY = r"^[^0-9@]*[=:]"
_SHAPES = {"run": "^[A-Za-z0-9]{12,}$", "parts": "^(?=.{12})[A-Za-z0-9]++(?:[-_.][A-Za-z0-9]++)++$"}
_WORD_TRUST = 0.5  # share of a pattern's confidence that an instance takes from it, where no shape bears the pattern out
_LONG_WORD = 64  # a longer word of a pattern is replaced by its digest


def _located(text: Column, regex: str, needed: Column) -> tuple[Column, Column]:
    """Matches of ``regex`` and the pieces of text around them (one more), none where not ``needed``."""
    none = F.array().cast("array<string>")
    return F.when(needed, F.regexp_extract_all(text, F.lit(regex), F.lit(0))).otherwise(none), F.when(needed, F.split(text, regex, -1)).otherwise(none)


def _starts(found: Column, pieces: Column) -> Column:
    """Starts of the matches in code points: running lengths of pieces and matches."""
    steps = F.zip_with(F.transform(pieces, F.length), F.transform(found, F.length), lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(F.filter(steps, lambda s: s["m"].isNotNull()), zero,
                       lambda acc, s: F.struct((acc["at"] + s["p"] + s["m"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + s["p"])).alias("out")),
                       lambda acc: acc["out"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled (less 9 if above 9); the sum divides by 10."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.forall(F.split(match, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.right(short(p), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        d = _digits(match)
        return F.length(d).between(14, 19) & F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _joined(spans: Column, names: list[str]) -> Column:
    """kind:start:end of an array of (start, kind number, end), in order, comma-joined."""
    name = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _last_words(piece: Column) -> Column:
    """The last two words of a piece of text, whole, with one space between them."""
    return F.substring_index(F.rtrim(F.regexp_replace(piece, SPACES, " ")), " ", -2)


def _short(word: Column) -> Column:
    return F.when(F.length(word) > _LONG_WORD, F.concat(F.lit("#"), F.sha2(word, 256))).otherwise(word)


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def find_personal_data(docs: DataFrame, rounds: int = 6, support: int = 3, confidence: float = 0.8, marked: float = 0.5,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added,
    n_spans`` for every row of ``docs``.

    Base matches are leftmost and non-overlapping per kind; those that fail the
    kind's check are dropped without a retry.  Counts and base_sha256 are of base
    spans only; spans lists added ones too, and n_spans counts all of them.  Null texts count as empty; rows that
    repeat an id keep their own spans; an empty table gives no rows.

    Patterns of a token are its key if it holds one (``password=``), else the
    last word before it, or the last two if the last has no letter or digit
    (``token =``); and the four letters that a value of some shape begins with.
    Shapes are unbroken runs of 12 or more letters and digits, and such runs
    with single ``-_.`` inside.  A base span that covers an instance gives it 1, else
    the best of its patterns counts, by half where no shape bears the pattern out.
    A shape has the mean score of its distinct instances, 0 for those without
    any confident pattern.  A pattern has the mean score of its instances; a
    key, a mark or a beginning in front of ``support`` different values
    or more takes the shape's score where that is higher, common words do not.
    After ``rounds`` rounds, instances of at least 6 characters and 4 digits, or of
    one of the shapes, behind a pattern of ``confidence`` or more (``marked`` or more
    where a shape bears it out) in ``support`` documents or more become ``id`` spans.  Tables of the graph hold one row per
    token, pattern or instance and are aggregated before each shuffle; the table
    of shapes has two rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    digit = F.col("text").rlike("[0-9]")
    rows = rows.withColumn("digit", digit)
    for kind, regex in KINDS.items():
        needed = F.lit(True) if _NEEDS[kind] is None else F.contains("text", F.lit(_NEEDS[kind]))
        needed = needed if kind == "email" else needed & F.col("digit")
        found, pieces = _located(F.col("text"), regex, needed)
        rows = rows.withColumns({f"m_{kind}": found, f"p_{kind}": pieces})
    tokens, around = _located(F.col("text"), _TOKEN, F.col("digit") | F.contains("text", F.lit("@")))
    rows = rows.withColumns({"m_token": tokens, "p_token": around}).drop("text", "digit")
    spans = {}
    for i, kind in enumerate(KINDS):
        m, at = F.col(f"m_{kind}"), _starts(F.col(f"m_{kind}"), F.col(f"p_{kind}"))
        all_ = F.zip_with(m, at, lambda x, s: F.struct(s.alias("start"), F.lit(i).alias("kind"), (s + F.length(x)).alias("end"), _valid_of(kind, x).alias("ok")))
        good = F.transform(F.filter(all_, lambda x: x["ok"]), lambda x: F.struct(x["start"], x["kind"], x["end"]))
        spans[f"s_{kind}"] = F.when(F.size(m) == 0, F.array().cast(_SPANS)).otherwise(good.cast(_SPANS))
    at = _starts(F.col("m_token"), F.col("p_token"))
    cands = F.transform(F.arrays_zip(F.col("m_token").alias("m"), at.alias("at"), F.slice("p_token", 1, F.greatest(F.lit(0), F.size("m_token"))).alias("p")),
                        lambda x: F.struct(x["at"].alias("start"), x["m"].alias("token"), _last_words(x["p"]).alias("front")))
    rows = rows.select("doc_id", F.expr("uuid()").alias("row"), *[v.alias(k) for k, v in spans.items()],
                       F.when(F.size("m_token") > 0, cands).alias("cands"))
    base = F.concat(*[F.col(f"s_{k}") for k in KINDS])
    rows = materialise(rows.select("doc_id", "row", *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in KINDS], base.alias("base"), "cands"),
                       "pii-rows")

    # The graph: a row per token.
    tok = rows.where("cands is not null").select("row", "base", F.explode("cands").alias("c")).select("row", "base", "c.*")
    key = F.regexp_extract("token", _KEY, 0)
    words = F.split(F.lower(F.regexp_replace("front", "[0-9]+", "0")), " ")
    last, second = F.element_at(words, -1), F.when(F.size(words) > 1, F.element_at(words, -2)).otherwise("")
    worded = last.rlike(r"[\p{L}0-9]")
    before = F.when(key != "", _short(F.lower(key))).when(worded, _short(last)).otherwise(F.concat_ws(" ", _short(second), _short(last)))
    cut = F.length(key) + F.length(F.regexp_extract(F.expr("substring(token, length(key) + 1)"), r"^[\"'(\[<]*", 0))
    tok = tok.withColumns({"before": before, "marked": (key != "") | (~worded & (last != "")), "key": key}).withColumn("cut", cut)
    tok = tok.withColumn("value", F.regexp_replace(F.expr("substring(token, cut + 1)"), r"[\"')\]>.,;:!#$%&*|?]+$", ""))
    tok = tok.withColumn("start", F.col("start") + F.col("cut")).withColumn("end", F.col("start") + F.length("value"))
    shape = F.coalesce(*[F.when(F.col("value").rlike(regex) & F.col("value").rlike("[0-9]"), name) for name, regex in _SHAPES.items()])
    covered = F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    tok = tok.withColumns({"shape": shape, "covered": covered})
    likely = (F.length("value") >= 6) & (F.length(_digits(F.col("value"))) >= 4) | F.col("shape").isNotNull()
    begins = F.when(F.col("shape").isNotNull(), F.regexp_extract("value", "^[A-Za-z]{4}", 0)).otherwise("")
    patterns = F.array(F.struct(F.concat(F.lit("<"), "before").alias("pattern"), F.col("marked").alias("marked")),
                       F.struct(F.concat(F.lit("^"), begins).alias("pattern"), F.lit(True).alias("marked")))
    tok = materialise(tok.select("row", "start", "end", "value", "shape", "covered", likely.alias("likely"),
                                 F.filter(patterns, lambda p: p["pattern"] != "^").alias("patterns"))
                      .where("covered or likely"), "pii-tokens")
    seeds = materialise(tok.groupBy("value", "shape").agg(F.max(F.col("covered").cast("double")).alias("seed")), "pii-seeds")
    edges = materialise(tok.select("row", "value", F.explode("patterns").alias("p")).groupBy("p.pattern", "p.marked", "value")
                        .agg(F.count("*").alias("n"), F.countDistinct("row").alias("docs")), "pii-edges")
    instance = seeds.withColumn("score", F.col("seed"))
    strong = None
    for _ in range(rounds):
        shapes = instance.where("shape is not null").groupBy("shape").agg(F.avg("score").alias("of_shape"))
        scored = edges.join(instance.join(F.broadcast(shapes), "shape", "left"), "value")  # a row for each of two shapes
        lifted = F.greatest("score", F.coalesce("of_shape", F.lit(0.0)))
        borne = F.col("marked") & (F.count("*") >= support)
        mean = lambda x: F.sum(F.col("n") * x) / F.sum("n")
        strong = (scored.groupBy("pattern", "marked")
                  .agg(F.when(borne, mean(lifted)).otherwise(mean(F.col("score"))).alias("conf"), borne.alias("borne"), F.sum("docs").alias("docs"))
                  .where(F.col("docs") >= support))
        strong = materialise(strong, "pii-patterns")
        given = F.col("conf") * F.when(F.col("borne"), 1.0).otherwise(_WORD_TRUST)
        reached = (edges.join(strong.select("pattern", "marked", given.alias("given")), ["pattern", "marked"])
                   .groupBy("value").agg(F.max("given").alias("best")))
        instance = materialise(seeds.join(reached, "value", "left")
                               .select("value", "shape", "seed", F.greatest("seed", F.coalesce("best", F.lit(0.0))).alias("score")), "pii-instances")
    sure = strong.where(F.col("conf") >= F.when(F.col("borne"), marked).otherwise(confidence)).select("pattern", "marked")
    new = (tok.where("likely and not covered").select("row", "start", "end", F.explode("patterns").alias("p"))
           .select("row", "start", "end", "p.*").join(sure, ["pattern", "marked"], "left_semi").select("row", "start", "end").distinct()
           .groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).cast(_SPANS).alias("added")))
    rows = rows.drop("cands").join(new, "row", "left").withColumn("added", F.coalesce("added", F.array().cast(_SPANS)))
    names = [*KINDS, "id"]
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_joined(F.col("base"), names), 256).alias("base_sha256"),
                       _joined(F.concat("base", "added"), names).alias("spans"), F.size("added").cast("long").alias("n_added"),
                       F.size(F.concat("base", "added")).cast("long").alias("n_spans"))


def _valid_of(kind: str, match: Column) -> Column:
    return F.coalesce(_valid(kind, match), F.lit(False))
