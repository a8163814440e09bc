"""The dealt operators applied to their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from tributary.llm import collocations, compression, jaccard, language, mixing, packing, pii, quality, secrets, sentencepieces, vectors, warc, whitening
from tributary.llm.registry import QUERIES, SQL, query
from tributary.sources.tables import Tables

__all__ = ["QUERIES", "SQL"]


@query("op10_mixing", """
    with sized as (
        select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
            md5(coalesce(cast(doc_id as varchar), text, '')) as k
        from documents),
    totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
    weighed as (
        select *, row_number() over (order by source nulls last) - 1 as s,
            case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w
        from totals),
    levels as (
        select *, ((select sum(source_size) from totals)::double
            - coalesce(sum(3.0::double * source_size) over (order by 3.0::double * source_size / w, s rows between unbounded preceding and 1 preceding), 0))
            / sum(w) over (order by 3.0::double * source_size / w, s rows between current row and unbounded following) as level
        from weighed),
    targets as (
        select *, round(least(3.0::double * source_size, (select max(level) from levels) * w), 6) as target,
            least(cast(round(least(3.0::double * source_size, (select max(level) from levels) * w), 6) as bigint), 3 * source_size) as words
        from levels),
    bounds as (
        select *, floor(coalesce(sum(words) over (order by s rows between unbounded preceding and 1 preceding), 0)::double * 4294967296.0::double / (select sum(words) from targets)::double) as low,
            floor(sum(words) over (order by s)::double * 4294967296.0::double / (select sum(words) from targets)::double) as high
        from targets),
    slots as (
        select p.id as slot, b.s, row_number() over (partition by b.s order by p.id) - 1 as rank
        from (select range as id, (range::hugeint * 2654435769) % 4294967296 as point
              from range(cast((select ceil(sum(words) / 4096.0) from targets) as bigint))) p
        join bounds b on p.point >= b.low and p.point < b.high),
    laid as (
        select d.*, t.s, t.source_size, t.target, t.words,
            sum(d.size) over (partition by t.s order by d.k, d.doc_id, d.size rows between unbounded preceding and current row) - d.size as start
        from sized d join targets t on d.source is not distinct from t.source),
    needed as (
        select s, source_size, words, cast(ceil(source_size / 4096.0) as bigint) as blocks,
            unnest(range((words // source_size) * cast(ceil(source_size / 4096.0) as bigint) + cast(ceil((words % source_size) / 4096.0) as bigint))) as rank
        from targets where words > 0),
    taking as (
        select n.s, n.rank % n.blocks as block, coalesce(x.slot, (select ceil(sum(words) / 4096.0) from targets)::bigint + n.rank) as slot,
            least(4096, n.source_size - (n.rank % n.blocks) * 4096, n.words - (n.rank // n.blocks) * n.source_size - (n.rank % n.blocks) * 4096) as many
        from needed n left join slots x on x.s = n.s and x.rank = n.rank),
    parts as (select *, unnest(range(cast(start // 4096 as bigint), cast((start + size - 1) // 4096 + 1 as bigint))) as block from laid where size > 0),
    takes as (
        select p.s, p.start, least(p.start + p.size, p.block * 4096 + t.many) - greatest(p.start, p.block * 4096) as n, t.slot
        from parts p join taking t on t.s = p.s and t.block = p.block)
    select l.doc_id, l.size, l.source_size, l.target, cast(coalesce(t.taken, 0) as bigint) as taken, cast(t.first_slot as bigint) as first_slot
    from laid l left join (select s, start, sum(n) as taken, min(slot) as first_slot from takes where n > 0 group by s, start) t
        on t.s = l.s and t.start = l.start and l.size > 0
""")
def op10(t: Tables) -> DataFrame:
    return mixing.mix(t("documents", "doc_id", "text", "source"))


@query("op8_warc", """
    with p as (
        select page_id, coalesce(html, '') as html, cast(strlen(coalesce(html, '')) as bigint) as n, sha256(coalesce(html, '')) as d from pages),
    firsts as (select d, min(page_id) as first from p where n >= 100 group by d)
    select page_id, n as payload_bytes, p.d as payload_digest,
        case when first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
        case when first is not null and page_id is distinct from first then first end as refers_to
    from p left join firsts on p.d = firsts.d and n >= 100
""")
def op8(t: Tables) -> DataFrame:
    return warc.archived(t("pages"))


@query("op9_sentencepiece")
def op9(t: Tables) -> DataFrame:
    return sentencepieces.digests(sentencepieces.encoded(t("documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")))


@query("op6_compression")
def op6(t: Tables) -> DataFrame:
    return compression.compression_rules(t("documents", "doc_id", "text"))


@query("op4_quality")
def op4(t: Tables) -> DataFrame:
    return quality.quality_scores(t("documents", "doc_id", "text"), t("labels", "doc_id", "quality"))


@query("op3_language")
def op3(t: Tables) -> DataFrame:
    return language.languages(t("documents", "doc_id", "text", "lang"))


@query("op7_secrets")
def op7(t: Tables) -> DataFrame:
    return secrets.secret_spans(t("documents", "doc_id", "text"))


@query("op1_pii")
def op1(t: Tables) -> DataFrame:
    return pii.personal_spans(t("documents", "doc_id", "text"))


@query("op5_vectors", """
    with v as (
        select vec_id, embedding::double[] as e,
            embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
                and len([x for x in embedding if x <> 0]) > 0 as ok
        from embeddings),
    pairs as (
        select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and a.ok and b.ok and len(a.e) = len(b.e)
        where list_cosine_similarity(a.e, b.e) >= 0.9)
    select v.vec_id, (select count(*) from pairs where a = v.vec_id) as n_links, r.component_id, v.vec_id = r.component_id as kept
    from v join (
        with recursive reach(node, other) using key (node) as (
            select vec_id, vec_id from v
            union
            select p.a, min(reach.other) from reach join pairs p on p.b = reach.node join recurring.reach as own on own.node = p.a
            where reach.other < own.other group by p.a)
        select node, other as component_id from reach) r on r.node = v.vec_id
""")
def op5(t: Tables) -> DataFrame:
    return vectors.near_duplicates(t("embeddings", "vec_id", "embedding"))


@query("op2_jaccard", """
    with words as (
        select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
    grams as (
        select distinct rid, list_aggregate(w[i:i + 4], 'string_agg', ' ') as g
        from (select rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
    sizes as (select rid, count(*) as n from grams group by rid),
    common as (select a.rid as a, b.rid as b, count(*) as c from grams a join grams b on a.g = b.g and a.rid <> b.rid group by all),
    pairs as (select a, b from common join sizes x on x.rid = a join sizes y on y.rid = b where 5 * c >= 4 * (x.n + y.n - c)),
    reached as (
        with recursive reach(node, least) using key (node) as (
            select rid, rid from words
            union
            select p.a, min(reach.least) from reach join pairs p on p.b = reach.node join recurring.reach as own on own.node = p.a
            where reach.least < own.least group by p.a)
        select node, least from reach),
    named as (select least, min(doc_id) as class_id from reached join words on rid = node group by least),
    counts as (select a, count(*) as n from pairs group by a)
    select doc_id, class_id, coalesce(counts.n, 0) as n_links, coalesce(doc_id = class_id, false) as kept
    from words join reached on node = words.rid join named using (least) left join counts on counts.a = words.rid
""")
def op2(t: Tables) -> DataFrame:
    return jaccard.jaccard_join(t("documents", "doc_id", "text"))


@query("op13_collocations", """
    with docs as (
        select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
    pieces as (select lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') as w from docs),
    grams as (
        select lang, k, array_to_string(w[i:i + k - 1], ' ') as g, count(*) as c
        from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, (values (1), (2), (3)) v(k)) group by all),
    totals as (select lang, cast(sum(c) as bigint) as n from grams where k = 1 group by lang),
    seen as (select lang, k, g, c as a, string_split(g, ' ') as w from grams where k > 1 and c >= 10),
    around as (
        select lang, g, max(a) as longest
        from (select lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as g, a from seen where k = 3) group by all),
    kept as (select s.* from seen s left join around x using (lang, g) where x.longest is null or s.k = 3 or 100 * x.longest < 50 * s.a),
    cuts as (select lang, g, a, k, unnest(range(1, k)) as cut, w from kept),
    scored as (
        select t.lang, t.g, t.a, t.cut, f.c as l, r.c as r, (1000000::hugeint * t.a * t.a) // (f.c::hugeint * r.c) as score
        from cuts t join grams f on f.lang = t.lang and f.g = array_to_string(t.w[1:t.cut], ' ')
        join grams r on r.lang = t.lang and r.g = array_to_string(t.w[t.cut + 1:t.k], ' ')),
    best as (select * from scored qualify row_number() over (partition by lang, g order by score, cut) = 1),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, g) as rank from best)
    select lang, rank, g as phrase, a, l, r, n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= 2000
""")
def op13(t: Tables) -> DataFrame:
    return collocations.collocations(t("documents", "text", "lang"))


@query("op12_whitening")
def op12(t: Tables) -> DataFrame:
    return whitening.whiten(t("embeddings", "vec_id", "embedding"))


@query("op11_packing")
def op11(t: Tables) -> DataFrame:
    return packing.packed(t("documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
