"""Reference SQL (DuckDB) of the queries that SQL can express.

Tokenizers (1, 3), XXH64 (9), boosted trees (8) and the packing of shards (10) are beyond
SQL, and near-duplicate sets (13) too slow in it on whole tables; these queries are tested
against brute force.
"""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
NORMALISED = f"trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), {BLANKS})"

def rounded(rate: str) -> str:
    """A rate with six significant digits at least."""
    cuts = [f"when r >= 1e{6 - d} then floor(r * 1e{d}) / 1e{d}" for d in range(6, 27, 3)]
    return f"(select case {' '.join(cuts)} else floor(r * 1e27) / 1e27 end from (select {rate} as r))"


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def assigned(k: int) -> str:
    """Each vector's nearest centroid of round k."""
    squared = "list_sum(list_transform(range(1, 65), lambda d: (v[d] - c[d]) * (v[d] - c[d])))"
    return f"""a{k} as materialized (
    select i, any_value(vec_id) as vec_id, any_value(v) as v, arg_min(cluster, distance * 16 + cluster) as cluster, min(distance)::bigint as distance
    from (select i, vec_id, v, cluster, {squared} as distance from kept, c{k}) group by i
)"""


def lloyd_round(k: int) -> str:
    """The centroids after round k + 1."""
    return f""", {assigned(k)}, m{k} as (
    select cluster, list(m order by d) as c from (
        select cluster, d, floor(sum(v[d])::hugeint / count(*))::bigint as m from a{k}, range(1, 65) r(d) group by cluster, d
    ) group by cluster
), c{k + 1} as materialized (
    select cluster, coalesce(m.c, o.c) as c from c{k} o left join m{k} m using (cluster)
)"""


SQL: dict[str, str] = {
    "op2_line_quality": rf"""
with docs as (
    select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {WORD}) as words from documents
), lines as (
    select doc_id, source, md5(text) as body, pos, line, {NORMALISED} as plain, len(regexp_extract_all(line, {WORD})) as n
    from (select doc_id, source, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from docs)
), candidates as (
    select source, plain, count(distinct body) as holders from lines where plain <> '' group by source, plain having count(distinct body) > 10
), texts as (
    select source, md5(text) as body, any_value(len(words)) as words from docs group by 1, 2
), found as (
    select l.source, l.body, l.plain, l.n, holders
    from (select distinct source, body, pos, plain, n from lines) l join candidates c on l.source is not distinct from c.source and l.plain = c.plain
), held as (
    select source, body, sum(n) as common, min(row(holders, substr(md5(plain), 1, 16))) filter (holders > 20) as rarest from found group by source, body
), marked as (
    select h.source, h.body, words - common < 0.3 * words as near, case when words - common < 0.3 * words then rarest[2]::varchar else h.body end as mark
    from held h join texts t on h.source is not distinct from t.source and h.body = t.body where rarest is not null
), over as (
    select f.source, plain from found f join marked m on f.source is not distinct from m.source and f.body = m.body where holders > 20
    group by f.source, plain having count(distinct (near, mark)) > 20
), per_line as (
    select doc_id, count(*) filter (n > 0) - count(distinct line) filter (n > 0) as n_dup_lines,
        count(*) filter (o.plain is not null) as n_lines_removed, sum(case when o.plain is null then n else 0 end)::bigint as n_words_left
    from lines l left join over o on o.source is not distinct from l.source and o.plain = l.plain group by doc_id
), grams as (
    select doc_id, i, array_to_string(words[i:i + 7], ' ') as gram from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from docs)
), again as (
    select doc_id, i from grams qualify count(*) over (partition by doc_id, gram) > 1
), repeats as (
    select doc_id, count(distinct i + k) as n_repeat_words from again, range(8) r(k) group by doc_id
), counted as (
    select doc_id, len(words)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        n_lines_removed, n_words_left
    from docs join per_line using (doc_id) left join repeats using (doc_id)
), failed as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
)
select *, not base_failed and not (n_lines_removed > 0 and n_words_left < 0.3 * n_words) as kept from failed
""",
    "op4_warc_chunks": """
with payloads as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
        max(page_id) over (partition by coalesce(html, '')) as newest
    from pages
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id < newest then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id < newest then newest end as refers_to
from payloads
""",
    "op5_lempel_ziv": f"""
with docs as (
    select doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) as words from documents
), windows as (
    select doc_id, i, array_to_string(words[i:i + 19], ' ') as body from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from docs)
), earlier as (
    select doc_id, i from windows qualify row_number() over (partition by body order by doc_id, i) > 1
), gone as (
    select distinct doc_id, i + k as i from earlier, range(20) r(k)
), spelled as (
    select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from docs
), kept as (
    select doc_id, string_agg(word, ' ' order by i) as text from spelled anti join gone using (doc_id, i) group by doc_id
), removed as (
    select doc_id, count(*) as n from gone group by doc_id
)
select doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from docs left join removed using (doc_id) left join kept using (doc_id)
""",
    "op6_poisson_mix": f"""
with recursive sizes as (
    select source, sum(length(coalesce(text, '')) + 1)::bigint as size from documents group by source
), rates as (
    select source, {rounded("sqrt(size::double) / (select sum(sqrt(size::double)) from sizes) * 1.0 * (select sum(size) from sizes)::double / size::double")} as rate
    from sizes
), means as (
    select source, rate, greatest(1, ceil(rate / 8.0)::int) as draws, rate / greatest(1, ceil(rate / 8.0)::int) as mean from rates
), cdf as (
    select source, draws, mean, 0 as k, exp(-mean) as p, exp(-mean) as c from means
    union all
    select source, draws, mean, k + 1, p * mean / (k + 1)::double, c + p * mean / (k + 1)::double from cdf where k < 63
), tables as (
    select source, list(c order by k) as cdf from cdf group by source
), drawn as (
    select d.*, rate, cdf,
        list_transform(range(1, draws + 1), lambda j:
            (('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':17:' || j::varchar), 1, 13))::bigint::double + 0.5) / 4503599627370496.0) as us
    from documents d join means m on d.source is not distinct from m.source join tables t on d.source is not distinct from t.source
), counted as (
    select * exclude (cdf, us), list_sum(list_transform(us, lambda u: len(list_filter(cdf, lambda c: c < u))))::int as n from drawn
), copies as (
    select * exclude (n), unnest(range(0, n))::int as copy from counted
)
select *, substr(md5(coalesce(doc_id::varchar, '') || ':17:copy:' || copy::varchar), 1, 16) as shuffle_key from copies
""",
    "op7_bond_search": """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), scored as (
    select q.vec_id as query_id, r.vec_id, list_dot_product(q.v, r.v)::bigint as score
    from usable q join usable r on q.vec_id <> r.vec_id and len(q.v) = len(r.v) where q.vec_id % 100 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 10
""",
    "op11_table_clusters": f"""
with kept as (
    select row_number() over () as i, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), c0 as materialized (
    select row_number() over (order by sha256('1:' || vec_id::varchar), v) - 1 as cluster, v as c from kept
    order by sha256('1:' || vec_id::varchar), v limit 16
){"".join(lloyd_round(k) for k in range(3))}, {assigned(3)}, placed as (
    select vec_id, cluster::int as cluster, distance from a3
), inertia as (
    select cluster, sum(distance)::bigint as cluster_inertia from placed group by cluster
)
select vec_id, cluster, distance, cluster_inertia, (select sum(distance)::bigint from placed) as inertia,
    (select sha256(array_to_string(c, ',')) from c3 where c3.cluster = placed.cluster) as centroid_sha256
from placed join inertia using (cluster)
""",
    "op12_importance_resample": rf"""
with texts as (
    select 0 as side, doc_id, lower_ascii as t from (select doc_id, {LOWERED} as lower_ascii from documents)
    union all select 1, null, {LOWERED} from benchmark
), worded as materialized (
    select row_number() over () as i, side, doc_id, regexp_extract_all(coalesce(t, ''), {LETTERS}) as words from texts
), spelled as (
    select i, side, unnest(words) as word from worded
), crc as (
    select list(list_reduce(list_concat([n], range(8)), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as t
    from range(256) r(n)
), distinct_words as (
    select word, xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(word)), lambda b: ('0x' || substr(hex(word), 2 * b + 1, 2))::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from (select distinct word from spelled), crc
), bucketed as (
    select i, side, bucket from spelled join distinct_words using (word)
), counts as (
    select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from bucketed group by bucket
), gains as (
    select bucket, floor(1000 * ln(((t + 1)::double * (all_s + 10000)::double) / ((s + 1)::double * (all_t + 10000)::double)))::bigint as gain
    from counts, (select sum(s) as all_s, sum(t) as all_t from counts)
), weights as (
    select i, sum(gain)::bigint as weight from bucketed join gains using (bucket) where side = 0 group by i
), scored as (
    select doc_id, len(words)::bigint as n_features, coalesce(weight, 0)::bigint as weight, (coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint::double + 0.5) / 4294967296.0))))::bigint as score
    from worded left join weights using (i) where side = 0
), ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20
)
select doc_id, n_features, weight, score,
    case when rank <= (select 10 * count(*) // 100 from ranked) then rank end::bigint as rank
from scored left join ranked using (doc_id)
""",
}
