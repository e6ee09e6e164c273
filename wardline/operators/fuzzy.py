"""Fuzzy dictionary resolution by edit distance.

Similarity join (J7) without a nested loop.  For t ≤ 2, two names within t
edits share a text that either becomes by deleting at most t characters; those
variants are the keys of an equi-join.  Such a key is as long as the name, so
a word that many names share is not one.  (Deletion neighbourhoods as in Bocek,
Hunt, Stiller, "Fast Similarity Search in Large Dictionaries", 2007.)  For
larger t, and names of over ``VARIANT_LENGTH`` characters, split each name into t+1
segments; a name within t edits of it must contain one of those segments
unchanged, shifted by a bounded number of positions (pigeonhole).  Candidates
come from an equi-join on ``(length, segment index, segment text)`` against
the substrings of each other name at the permitted positions, and are then
verified with the bounded ``levenshtein``.  The result is exact, the join is a
shuffle on hashed keys, and nothing is broadcast: joins ask for a merge, as the
size that Spark expects of exploded rows is that of the names they come from.
(Partition-based filtering as in Li, Deng, Wang, Feng, "Pass-Join", VLDB 2012.)

Dictionary growth (Z3) is order dependent: a name becomes a key when no
earlier key lies within t.  That is the lexicographically-first maximal
independent set of the similarity graph, component by component.  Components of
at most ``LOCAL_EDGES`` edges are dealt to tasks, which follow the sequential
rule over the components they get.  In larger ones it is computed in rounds: a
name is rejected once an earlier neighbour is a key, and becomes a key once
every earlier neighbour is rejected (Blelloch, Fineman, Shun, SPAA 2012).  Each
round is a join of the edge list with the state; lineage is cut with a
reliable checkpoint in the session's checkpoint folder.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.refs import ref
from wardline.operators.connect import connected_components
from wardline.session import checkpoint_dir

LOCAL_EDGES = 100_000  # similar pairs of a component that one task settles


def _segments(names: DataFrame, t: int) -> DataFrame:
    """(name, L, seg, text): the t+1 even segments of each name."""
    k = t + 1
    L = F.length("name")
    base, extra = F.floor(L / k).cast("int"), (L % k).cast("int")
    i = F.col("seg")
    long_from = F.lit(k) - extra          # segments from this index on are one longer
    seg_len = base + F.when(i >= long_from, 1).otherwise(0)
    start = i * base + F.greatest(F.lit(0), i - long_from)
    return (names.select("name", L.alias("L"), F.explode(F.sequence(F.lit(0), F.lit(t))).alias("seg"))
            .select("name", "L", "seg", F.substring("name", start + 1, seg_len).alias("text"),
                    seg_len.alias("_len")))


def _probes(names: DataFrame, t: int) -> DataFrame:
    """(name, L, seg, text): substrings a name offers to partners of length L.

    For segment ``i`` (0-based) starting at ``p`` in a partner of length L and
    a probing name longer by ``d``, only starts in
    ``[max(p - i, p + d - (t - i)), min(p + i, p + d + (t - i))]`` are needed:
    some segment is matched with at most ``i`` edits on its left and ``t - i``
    on its right (multi-match-aware selection, Pass-Join).
    """
    k = t + 1
    width = 2 * t + 1
    n_combo = width * k * width
    Ls = F.length("name")
    idx = F.col("_i")
    L = Ls - t + (idx / (k * width)).cast("int")
    seg = ((idx / width).cast("int") % k).cast("int")
    shift = (idx % width) - t
    d = Ls - L
    base, extra = F.floor(L / k).cast("int"), (L % k).cast("int")
    long_from = F.lit(k) - extra
    seg_len = base + F.when(seg >= long_from, 1).otherwise(0)
    p = seg * base + F.greatest(F.lit(0), seg - long_from)
    start = p + shift
    in_window = (shift >= F.greatest(-seg, d - (t - seg))) & (shift <= F.least(seg, d + (t - seg)))
    ok = (L >= 0) & in_window & (start >= 0) & (start + seg_len <= Ls)
    exploded = names.select("name", F.explode(F.sequence(F.lit(0), F.lit(n_combo - 1))).alias("_i"))
    return (exploded.select("name", L.alias("L"), seg.alias("seg"), start.alias("_start"),
                            seg_len.alias("_len"), ok.alias("_ok"))
            .where("_ok")
            .select("name", "L", "seg", F.substring("name", F.col("_start") + 1, F.col("_len")).alias("text"))
            .distinct())


VARIANT_LENGTH = 64  # a name of n characters has about n ** t / t! variants


def _variants(names: DataFrame, t: int) -> DataFrame:
    """(name, text): each name with up to ``t`` characters deleted."""
    shorter = lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(x))),
                                    lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    texts = F.array("name")
    for _ in range(t):
        texts = F.array_distinct(F.concat(texts, F.flatten(F.transform(texts, shorter))))
    return names.select("name", F.explode(texts).alias("text"))


def similar_pairs(names: DataFrame, threshold: int, name_col: str = "name") -> DataFrame:
    """All unordered pairs of distinct names within ``threshold`` edits.

    Output: ``name_a < name_b`` and their ``distance``.  Case-sensitive.
    """
    t = int(threshold)
    if t < 0:
        raise ValueError("threshold must be >= 0")
    distinct = names.select(ref(name_col).cast("string").alias("name")).where(F.col("name").isNotNull()).distinct()
    cand = None
    if t <= 2:
        variants = _variants(distinct.where(F.length("name") <= VARIANT_LENGTH), t)
        cand = (variants.withColumnRenamed("name", "name_a").join(variants.withColumnRenamed("name", "name_b").hint("merge"), "text")
                .where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b").distinct())
        # Pairs with a longer name: of names that are at most t characters shorter than the bound, or longer.
        distinct = distinct.where(F.length("name") > VARIANT_LENGTH - t)
    segs = _segments(distinct, t).select(F.col("name").alias("name_a"), "L", "seg", "text")
    probes = _probes(distinct, t).select(F.col("name").alias("name_b"), "L", "seg", "text")
    long = (segs.join(probes.hint("merge"), ["L", "seg", "text"])
            .where(F.col("name_a") < F.col("name_b"))
            .select("name_a", "name_b").distinct())
    cand = long if cand is None else cand.unionByName(long).distinct()
    dist = F.levenshtein("name_a", "name_b", t)
    return cand.select("name_a", "name_b", dist.alias("distance")).where(F.col("distance") >= 0)


def _order_key(prefix: str):
    return F.struct(F.col(f"{prefix}_prio"), F.col(f"{prefix}_ord"), ref(prefix))


def dictionary_rounds(names: DataFrame, threshold: int, existing: DataFrame | None = None,
                      order_col: str | None = None, name_col: str = "name",
                      checkpoint_every: int = 1, max_rounds: int | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """Grow a dictionary from ``names`` in order (Z3); returns the decision per name.

    Order: existing keys first, then ``order_col`` (if given), then the name.
    Output columns: name, comorb_key (the name itself for keys, the single
    similar earlier key for mergeable names, null for ambiguous ones),
    n_similar (earlier keys within the threshold), is_key, is_existing.
    """
    spark = names.sparkSession
    checkpoint_dir(spark)
    t = int(threshold)
    # A null position comes first, as the least one does.
    order = F.coalesce(ref(order_col).cast("long"), F.lit(-(1 << 63))) if order_col else F.lit(0).cast("long")
    new = names.select(ref(name_col).cast("string").alias("name"), order.alias("ord"), F.lit(1).alias("prio"))
    nodes = new.where(F.col("name").isNotNull())
    if existing is not None:
        old = existing.select(ref(existing.columns[0]).cast("string").alias("name"),
                              F.lit(0).cast("long").alias("ord"), F.lit(0).alias("prio"))
        nodes = old.unionByName(nodes)
    # One row per name: its earliest position (an existing key wins).
    nodes = (nodes.groupBy("name").agg(F.min(F.struct("prio", "ord")).alias("_o"))
             .select("name", F.col("_o.prio").alias("prio"), F.col("_o.ord").alias("ord")))
    nodes = nodes.checkpoint()

    pairs = similar_pairs(nodes, t)
    a = nodes.select(F.col("name").alias("name_a"), F.col("prio").alias("name_a_prio"), F.col("ord").alias("name_a_ord"))
    b = nodes.select(F.col("name").alias("name_b"), F.col("prio").alias("name_b_prio"), F.col("ord").alias("name_b_ord"))
    pairs = pairs.join(a.hint("merge"), "name_a").join(b.hint("merge"), "name_b")
    a_first = _order_key("name_a") < _order_key("name_b")
    ends = [F.struct(F.col(f"name_{x}_prio").alias("prio"), F.col(f"name_{x}_ord").alias("ord"), F.col(f"name_{x}").alias("name")) for x in "ab"]
    edges = pairs.select(F.when(a_first, ends[0]).otherwise(ends[1]).alias("first"), F.when(a_first, ends[1]).otherwise(ends[0]).alias("second"))
    edges = edges.select(*[F.col(f"{end}.{c}").alias(f"{x}{c}") for end, x in (("first", "u"), ("second", "v")) for c in ("name", "prio", "ord")])
    edges = edges.withColumnsRenamed({"uname": "u", "vname": "v"}).checkpoint()

    settled = _settled(edges, local_edges)
    alone = F.when(F.col("prio") == 0, F.lit("K"))                # existing keys are keys
    state = (nodes.join(settled.withColumnRenamed("state", "local").hint("merge"), "name", "left")
             .select("name", "prio", alone.when(F.col("large"), F.lit("U")).otherwise(F.coalesce("local", F.lit("K"))).alias("state")).checkpoint())
    still_open = state.where(F.col("state") == "U").limit(1).count()
    # state: K = key, R = rejected, U = undecided, which only names of large components are.
    large = edges.join(state.where(F.col("state") == "U").select(F.col("name").alias("v")).hint("merge"), "v", "left_semi") if still_open else None
    large = large.select("u", "v").checkpoint() if still_open else None
    rounds = 0
    while still_open:
        st_u = state.select(F.col("name").alias("u"), F.col("state").alias("su"))
        seen = (large.join(st_u.hint("merge"), "u")
                .groupBy(F.col("v").alias("name"))
                .agg(F.max((F.col("su") == "K").cast("int")).alias("any_key"),
                     F.max((F.col("su") == "U").cast("int")).alias("any_open")))
        nxt = (state.join(seen.hint("merge"), "name", "left")
               .select("name", "prio",
                       F.when(F.col("state") != "U", F.col("state"))
                       .when(F.coalesce(F.col("any_key"), F.lit(0)) == 1, F.lit("R"))
                       .when(F.coalesce(F.col("any_open"), F.lit(0)) == 0, F.lit("K"))
                       .otherwise(F.lit("U")).alias("state")))
        rounds += 1
        state = nxt.checkpoint() if rounds % checkpoint_every == 0 else nxt
        still_open = state.where(F.col("state") == "U").limit(1).count()
        if still_open and max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"dictionary growth did not settle in {max_rounds} rounds")

    keys = state.where(F.col("state") == "K").select(F.col("name").alias("u"))
    near_keys = (edges.join(keys.hint("merge"), "u")
                 .groupBy(F.col("v").alias("name"))
                 .agg(F.count(F.lit(1)).alias("n_similar"), F.min("u").alias("_one")))
    return (state.join(near_keys.hint("merge"), "name", "left")
            .select("name",
                    F.when(F.col("state") == "K", F.col("name"))
                    .when(F.col("n_similar") == 1, F.col("_one")).alias("comorb_key"),
                    F.when(F.col("state") == "K", F.lit(0)).otherwise(F.col("n_similar")).cast("long").alias("n_similar"),
                    (F.col("state") == "K").alias("is_key"),
                    (F.col("prio") == 0).alias("is_existing")))


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sequential rule over whole components: a name is a key unless an earlier neighbour is one."""
    before: dict = {}
    order: dict = {}
    for u, up, uo, v, vp, vo in zip(*(pdf[c] for c in ("u", "uprio", "uord", "v", "vprio", "vord"))):
        order[u], order[v] = (up, uo, u), (vp, vo, v)
        before.setdefault(v, []).append(u)
    keys = set()
    for name in sorted(order, key=order.get):
        if order[name][0] == 0 or not any(u in keys for u in before.get(name, ())):
            keys.add(name)
    return pd.DataFrame([(n, "K" if n in keys else "R") for n in order], columns=["name", "state"])


def _settled(edges: DataFrame, local_edges: int) -> DataFrame:
    """``name, state, large`` of every name with a similar one: K or R in small components, null where ``large``.

    Small components are dealt to groups of about ``local_edges`` edges; names
    compare by code points there, as Spark compares them.
    """
    comp = connected_components(edges, "u", "v").checkpoint()
    edges = edges.join(comp.withColumnRenamed("node", "u").hint("merge"), "u")
    sizes = edges.groupBy("component").agg(F.count(F.lit(1)).alias("m")).checkpoint()
    small = sizes.where(F.col("m") <= local_edges)
    groups = int(small.agg(F.ceil(F.sum("m") / max(1, local_edges))).first()[0] or 1)
    dealt = edges.join(small.select("component").hint("merge"), "component", "left_semi").withColumn("deal", F.pmod(F.xxhash64("component"), F.lit(groups)))
    followed = dealt.drop("component").groupBy("deal").applyInPandas(_follow, "name string, state string")
    big = comp.join(sizes.where(F.col("m") > local_edges).select("component").hint("merge"), "component", "left_semi")
    return followed.select("name", "state", F.lit(False).alias("large")).unionByName(
        big.select(F.col("node").alias("name"), F.lit(None).cast("string").alias("state"), F.lit(True).alias("large"))).checkpoint()


def resolve_names(names: DataFrame, threshold: int, existing: DataFrame | None = None,
                  conflicts: str = "merge", policy: str = "tabular", name_col: str = "name",
                  order_col: str | None = None) -> DataFrame:
    """Resolve names against a growing dictionary (Z1 tabular, Z2 document).

    Returns (name, comorb_key, n_similar, action) where action is one of
    ``existing`` (exact match), ``new_key``, ``merged``, ``skipped``,
    ``dropped``.  Rows with a null ``comorb_key`` are not linked.  ``raise``
    fails eagerly, listing up to 20 offending names.
    """
    if conflicts not in ("merge", "ignore", "raise"):
        raise ValueError(f"unknown conflicts policy {conflicts!r}; known: ignore, merge, raise")
    if policy not in ("tabular", "document"):
        raise ValueError("policy must be 'tabular' or 'document'")
    distinct = names.select(ref(name_col).cast("string").alias("name")).where(F.col("name").isNotNull())
    if order_col:
        distinct = names.select(ref(name_col).cast("string").alias("name"), ref(order_col).alias("_ord"))
    if policy == "document" and conflicts == "ignore":
        # Every unseen name becomes its own key: no similarity test at all.
        out = distinct.select("name").distinct().select(
            "name", F.col("name").alias("comorb_key"), F.lit(0).cast("long").alias("n_similar"))
        if existing is not None:
            ex = existing.select(ref(existing.columns[0]).cast("string").alias("name")).distinct()
            ex_flag = ex.withColumn("_ex", F.lit(True))
            out = out.join(ex_flag.hint("merge"), "name", "left")
            return out.select("name", "comorb_key", "n_similar",
                              F.when(F.col("_ex"), F.lit("existing")).otherwise(F.lit("new_key")).alias("action"))
        return out.withColumn("action", F.lit("new_key"))

    decided = dictionary_rounds(distinct, threshold, existing, "_ord" if order_col else None)
    if existing is not None:
        # Existing keys are context only: they appear in the output when a new name matches exactly.
        seen = distinct.select("name").distinct()
        decided = decided.join(seen.hint("merge"), "name", "left_semi")
    n = F.col("n_similar")
    action = (F.when(F.col("is_existing"), F.lit("existing"))
              .when(F.col("is_key"), F.lit("new_key")))
    if policy == "tabular":
        action = (action.when((n == 1) & F.lit(conflicts == "merge"), F.lit("merged"))
                  .when(n == 1, F.lit("skipped"))
                  .otherwise(F.lit("dropped")))
        offending = (n >= 1) & ~F.col("is_key")
    else:  # document: merge links a single similar key, anything else raises
        action = action.when((n == 1) & F.lit(conflicts == "merge"), F.lit("merged")).otherwise(F.lit("error"))
        offending = ~F.col("is_key") & ((n > 1) | F.lit(conflicts == "raise"))
    if conflicts == "raise" or policy == "document":
        bad = decided.where(offending).select("name", "n_similar").limit(20).collect()
        if bad:
            listed = ", ".join(f"{r['name']} ({r['n_similar']} similar keys)" for r in bad)
            raise ValueError(f"Names conflict with existing comorbidity keys: {listed}")
    key = F.when(F.col("action").isin("existing", "new_key", "merged"), F.col("comorb_key"))
    return (decided.withColumn("action", action)
            .select("name", key.alias("comorb_key"), "n_similar", "action"))
