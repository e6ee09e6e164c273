"""Registered queries of the operators and their DuckDB SQL.

Each query reads its whole tables through its operator and derives the columns
of its contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.llm import line_crf, toxicity
from wardline.llm.common import scratch_path, table
from wardline.llm.exact_dedup import exact_groups
from wardline.llm.fill_middle import fill_middle, restore
from wardline.llm.grid_join import near_vectors
from wardline.llm.hard_negatives import hard_negatives
from wardline.llm.html_diff import extract_main_text
from wardline.llm.labelled import fold
from wardline.llm.mix_sources import mix
from wardline.llm.ngram_join import ngram_groups
from wardline.llm.perplexity_rules import perplexity_rules
from wardline.llm.pii_bootstrap import find_personal_data
from wardline.llm.piece_sampling import sample_pieces
from wardline.llm.warc_chunks import read_records, write_archives


def op8_exact_dedup(spark, d):
    return exact_groups(table(spark, d, "documents"), digest_all=True)


def op3_mix_sources(spark, d):
    return mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


def op10_ngram_join(spark, d):
    return ngram_groups(table(spark, d, "documents"))


def op4_grid_join(spark, d):
    return near_vectors(table(spark, d, "embeddings"))


def op1_line_crf(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    scores = line_crf.quality_scores(docs, line_crf.train(docs, labels))
    return scores.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_toxicity(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    scores = toxicity.toxicity_scores(docs, toxicity.train(docs, labels))
    return scores.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_html_diff(spark, d):
    return extract_main_text(table(spark, d, "pages"))


def op7_warc_chunks(spark, d):
    path = scratch_path(spark, "archives")
    write_archives(table(spark, d, "pages"), path)
    return read_records(spark, path).drop("url")


def op9_pii_bootstrap(spark, d):
    return find_personal_data(table(spark, d, "documents"))


def op6_piece_sampling(spark, d):
    return sample_pieces(table(spark, d, "documents"), check=True)


def op11_perplexity_rules(spark, d):
    return perplexity_rules(table(spark, d, "documents"))


def op12_bond_negatives(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_fill_middle(spark, d):
    rows = fill_middle(table(spark, d, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                       sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


QUERIES = {
    "op1_line_crf": op1_line_crf,
    "op2_html_diff": op2_html_diff,
    "op3_mix_sources": op3_mix_sources,
    "op4_grid_join": op4_grid_join,
    "op5_toxicity": op5_toxicity,
    "op6_piece_sampling": op6_piece_sampling,
    "op7_warc_chunks": op7_warc_chunks,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pii_bootstrap": op9_pii_bootstrap,
    "op10_ngram_join": op10_ngram_join,
    "op11_perplexity_rules": op11_perplexity_rules,
    "op12_bond_negatives": op12_bond_negatives,
    "op13_fill_middle": op13_fill_middle,
}

SQL = {
    "op12_bond_negatives": """
        with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          list_transform(embedding, lambda x: floor(256 * x::double)) as e
                   from embeddings where vec_id is not null and label is not null and embedding is not null
                     and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.e, b.e)::bigint as score
              from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where a.vec_id % 100 = 0),
        p as (select *, row_number() over (partition by anchor_id order by score desc, id) as k from s where same qualify k <= 5)
        select p.anchor_id, p.id as positive_id, row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id)::int as rank,
               s.id as negative_id, p.score as positive_score, s.score as negative_score
        from p join s on s.anchor_id = p.anchor_id and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
        qualify rank <= 10""",
    "op13_fill_middle": """
        with h as (select doc_id, coalesce(text, '') as t, length(coalesce(text, ''))::bigint as n, sha256('1:' || coalesce(doc_id::varchar, 'null')) as h from documents),
        d as (select *, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from h),
        c as (select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                     case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                          when h4 % 100 < 20 then 'spm' else 'psm' end as form from d),
        p as (select *, substr(t, 1, a) as x, substr(t, a + 1, b - a) as y, substr(t, b + 1) as z from c)
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y
                      else '<S>' || z || '<P>' || x || '<M>' || y end) as output_sha256, sha256(t) as restored_sha256
        from p""",
    "op10_ngram_join": r"""
        with recursive w as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') as words from documents),
        s as (select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
              from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from w where len(words) > 0)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
              group by 1, 2),
        l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)),
        e as (select a, b from l union all select b, a from l),
        r(node, seen) as (select doc_id, doc_id from documents union select node, e.b from r join e on r.seen = e.a)
        select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r.seen) as component_id
        from documents d left join n using (doc_id) join r on r.node = d.doc_id group by d.doc_id, n.n""",
    "op7_warc_chunks": """
        with p as (select page_id, strlen(coalesce(html, ''))::bigint as n, sha1(coalesce(html, '')) as digest from pages),
             g as (select digest, max(page_id) as last from p where n >= 1000 group by digest)
        select page_id, n as payload_bytes, p.digest as payload_digest,
               case when last is null or page_id is not distinct from last then 'response' else 'revisit' end as record_type,
               case when page_id is distinct from last then last end as refers_to
        from p left join g on p.digest = g.digest and n >= 1000""",
    "op4_grid_join": """
        with recursive v as (
            select vec_id, label, len(embedding) as dim, embedding::double[] as e from embeddings
            where vec_id is not null and label is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l as (select a.vec_id as a, b.vec_id as b from v a join v b
              on a.label = b.label and a.dim = b.dim and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.93),
        r(node, seen) as (select vec_id, vec_id from v union select r.node, l.b from r join l on r.seen = l.a),
        c as (select node, min(seen) as component_id from r group by node),
        n as (select a, count(*) as n from l group by a)
        select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
               coalesce(vec_id = coalesce(component_id, vec_id), false) as kept
        from embeddings left join n on a = vec_id left join c on node = vec_id""",
    "op8_exact_dedup": r"""
        with h as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as sha
                   from documents),
             g as (select sha, min(doc_id) as keep_id, count(*) as n from h group by sha)
        select doc_id, keep_id, n::bigint as group_size, doc_id is not distinct from keep_id as kept, sha as text_sha256
        from h join g using (sha)""",
    "op3_mix_sources": r"""
        with d as (
            select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
                   len(regexp_extract_all(coalesce(text, ''), '[!#$%&*|]')) as marks,
                   (('0x' || substr(md5('17:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5)
                       / 4503599627370496.0::double as u, md5(coalesce(text, '')) as tie
            from documents),
        k as (select *, -ln(u) / greatest(0.05::double, 1 - 5.0::double * marks / greatest(1, size)) as key from d),
        s as (select source, sum(size)::bigint as source_size,
                     [5.0::double, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
              from d group by source),
        r as (select *, 2.0::double * source_size as most, 2.0::double * source_size / weight as fill from s),
        l as (select *, (1.5::double * sum(source_size) over ()
                         - coalesce(sum(most) over (order by fill, source nulls last rows between unbounded preceding and 1 preceding), 0))
                        / sum(weight) over (order by fill, source nulls last rows between current row and unbounded following) as level
              from r),
        w as (select arg_min(level, fill) as level from l where level * weight <= most),
        t as (select source, source_size, coalesce(least(most, w.level * weight), most) as target from l left join w on true),
        p as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from t),
        o as (select k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size as rest,
                     sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.tie
                                       rows between unbounded preceding and current row) - k.size as start
              from k join p on k.source is not distinct from p.source)
        select doc_id, size, source_size, target,
               (epochs + case when rest > 0 and start + size / 2.0::double <= rest then 1 else 0 end)::bigint as copies,
               ((epochs + case when rest > 0 and start + size / 2.0::double <= rest then 1 else 0 end) * size)::bigint as taken
        from o""",
}
