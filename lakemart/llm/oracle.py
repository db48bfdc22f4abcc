"""The registered queries in SQL of DuckDB, where SQL can express them."""

from __future__ import annotations

from functools import reduce

from lakemart.llm.license_scan import _NOTICES, COPYRIGHT_LINE, NOT_WORD, SPELLINGS

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Smallest id that links reach, for a relation links(a, b) that holds both directions.
_REACH = """
reach as (
    select a as id, b as other from links
    union
    select r.id, l.b from reach r join links l on l.a = r.other
),
least as (select id, min(other) as other from reach group by id)"""

OP1 = f"""
with recursive vectors as (
    select vec_id, e, sqrt(list_dot_product(e, e)) as norm from (select vec_id, embedding::double[] as e from embeddings)
),
links as (
    select x.vec_id as a, y.vec_id as b from vectors x join vectors y on x.vec_id <> y.vec_id
    where list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.9
),{_REACH}
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links,
    least(e.vec_id, coalesce(l.other, e.vec_id)) as component_id,
    e.vec_id = least(e.vec_id, coalesce(l.other, e.vec_id)) as kept
from embeddings e left join least l on l.id = e.vec_id"""

OP2 = f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(text, {_LETTERS}), '[^\\x20\\x09-\\x0D]+') as w
    from documents
),
shingles as (
    select distinct doc_id, unnest(
        case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
             when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as c
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all
),
links as (
    select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * c >= 80 * (p.n + q.n - c)
),{_REACH}
select d.doc_id, coalesce(s.n, 0) as n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) as component_id
from documents d left join sizes s using (doc_id) left join least l on l.id = d.doc_id"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    plain = f"regexp_replace(lower({text}), {_quoted(COPYRIGHT_LINE)}, '', 'g')"
    plain = f"regexp_replace({plain}, {_quoted(NOT_WORD)}, ' ', 'g')"
    return reduce(lambda t, s: f"regexp_replace({t}, {_quoted(s[0])}, {_quoted(s[1])}, 'g')", SPELLINGS, plain)


def _canonical_lines(text: str) -> str:
    split = f"string_split({_canonical(text)}, chr(10))"
    return f"list_filter(list_transform({split}, lambda x: trim(x, ' ')), lambda x: x <> '')"


OP4 = f"""
with known as (
    select sha256(array_to_string({_canonical_lines("t")}, ' ')) as digest, min(id) as id
    from (values {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in _NOTICES)}) v(id, t) group by 1
),
texts as (
    select doc_id, {_canonical_lines("coalesce(text, '')")} as lines, row_number() over () as r from documents
),
wholes as (select *, sha256(array_to_string(lines, ' ')) as canonical_sha256 from texts),
hits as (
    select r, count(*) as n, string_agg(distinct id, ',' order by id) as ids
    from (select r, unnest(lines) as line from wholes) join known on digest = sha256(line) group by r
)
select doc_id, canonical_sha256, max(known.id) as license_id, coalesce(max(n), 0)::bigint as n_notices,
    coalesce(max(ids), '') as notices, count(*) as n_rows
from wholes left join known on digest = canonical_sha256 left join hits using (r)
group by doc_id, canonical_sha256"""

_PLAIN = f"trim(regexp_replace(translate(unit, {_LETTERS}), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ')"

#: Lines of five words on, and sentences of eight words on within the lines that stay.
OP5 = f"""
with lines as (
    select doc_id, unnest(l) as unit, generate_subscripts(l, 1) as k
    from (select doc_id, string_split(regexp_replace(text, '(\\n)', '\\1' || chr(57344), 'g'), chr(57344)) as l from documents)
),
placed_lines as (
    select *, coalesce(sum(strlen(unit)) over (
        partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0)::bigint as first
    from lines where unit <> ''
),
sentences as (
    select doc_id, k, first as line_first, unnest(l) as unit, generate_subscripts(l, 1) as j
    from (select *, string_split(regexp_replace(unit, '([.!?][ \\t]+|\\n)', '\\1' || chr(57344), 'g'), chr(57344)) as l from placed_lines)
),
placed_sentences as (
    select *, line_first + coalesce(sum(strlen(unit)) over (
        partition by doc_id, k order by j rows between unbounded preceding and 1 preceding), 0)::bigint as first
    from sentences where unit <> ''
),
units as (
    select doc_id, first, {_PLAIN} as plain, 5 as least from placed_lines
    union all select doc_id, first, {_PLAIN}, 8 from placed_sentences
),
earliest as (
    select plain, min(struct_pack(d := doc_id, f := first)) as place
    from units where len(string_split(plain, ' ')) >= least group by plain
),
judged_lines as (
    select l.doc_id, l.k, l.first, l.unit, len(string_split({_PLAIN}, ' ')) >= 5
        and e.place is distinct from struct_pack(d := l.doc_id, f := l.first) and e.place is not null as later
    from placed_lines l left join earliest e on e.plain = {_PLAIN}
),
judged as (
    select s.doc_id, s.first, s.unit, l.later as line_later, l.first as line_first, l.unit as line,
        len(string_split({_PLAIN.replace("unit", "s.unit")}, ' ')) >= 8
        and e.place is distinct from struct_pack(d := s.doc_id, f := s.first) and e.place is not null as later
    from placed_sentences s join judged_lines l using (doc_id, k)
    left join earliest e on e.plain = {_PLAIN.replace("unit", "s.unit")}
),
spans as (
    select doc_id, line_first as a, line_first + strlen(line) as b from judged where line_later group by all
    union all select doc_id, first, first + strlen(unit) from judged where later and not line_later
),
cut as (
    select doc_id, count(*) as n_removed, string_agg(a || '-' || b, ',' order by a) as removed from spans group by doc_id
),
rest as (
    select doc_id, string_agg(unit, '' order by first) as kept from judged where not later and not line_later group by doc_id
)
select d.doc_id, coalesce(n_removed, 0) as n_removed, coalesce(removed, '') as removed, sha256(coalesce(kept, '')) as kept_sha256
from documents d left join cut using (doc_id) left join rest using (doc_id)"""

OP6 = """
with lines as (select doc_id, string_split(text, chr(10)) as l from documents),
hashed as (select *, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 8))::bigint) as h from lines),
cut as (
    select *, list_filter(range(1, len(l) + 1),
        lambda i: i = len(l) or (coalesce(h[i - 1], 0) * 31 + h[i]) % 4 = 0) as e
    from hashed
),
chunks as (
    select doc_id, k - 1 as k, e[k] - coalesce(e[k - 1], 0) as n,
        array_to_string(l[coalesce(e[k - 1], 0) + 1 : e[k]], chr(10)) as body
    from (select *, unnest(range(1, len(e) + 1)) as k from cut)
),
ranked as (
    select *, n > 1 and row_number() over (partition by n > 1, body order by doc_id, k) > 1 as later from chunks
)
select d.doc_id, count(k) as n_chunks, coalesce(string_agg(k::varchar, ',' order by k) filter (later), '') as removed,
    sha256(coalesce(string_agg(body, chr(10) order by k) filter (not later), '')) as kept_sha256
from documents d left join ranked r using (doc_id) group by d.doc_id"""


def _assigned(book: str) -> str:
    """Each part's nearest entry, the lower one on ties, as (r, p, e, error)."""
    return f"""
    select r, p, min(struct_pack(q := q, e := e)).e as e, min(struct_pack(q := q, e := e)).q as error from (
        select c.r, c.p, b.e, sum((c.x - b.x) * (c.x - b.x))::bigint as q
        from components c join {book} b using (p, d) group by c.r, c.p, b.e
    ) group by r, p"""


def _moved(book: str, assigned: str) -> str:
    return f"""
    select b.p, b.e, b.d, coalesce(m.x, b.x) as x from {book} b left join (
        select c.p, a.e, c.d, floor(sum(c.x)::double / count(*))::bigint as x
        from components c join {assigned} a using (r, p) group by c.p, a.e, c.d
    ) m using (p, e, d)"""


OP11 = f"""
with kept as (
    select row_number() over (order by vec_id) as r, vec_id, label,
        list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
components as (
    select r, (i // (len(v) // 16))::int as p, (i % (len(v) // 16))::int as d, v[i + 1] as x
    from (select *, unnest(range(0, len(v))) as i from kept)
),
book0 as (select p, (r - 1)::int as e, d, x from components where r <= 64),
near0 as ({_assigned("book0")}),
book1 as ({_moved("book0", "near0")}),
near1 as ({_assigned("book1")}),
book2 as ({_moved("book1", "near1")}),
near2 as ({_assigned("book2")}),
coded as (
    select vec_id, label, string_agg(lpad(format('{{:x}}', e), 2, '0'), '' order by p) as code, sum(error)::bigint as error
    from near2 join kept using (r) group by r, vec_id, label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
    (select sha256(string_agg(x::varchar, ',' order by p, e, d)) from book2) as codebooks_sha256
from coded"""

OP13 = """
with letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order
    from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
    join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)
),
texts as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
    from documents
),
firsts as (select text, min(doc_id) as first from texts group by text),
judged as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
failing as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
        case when len(w) < 50 then 'A' else '' end
        || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
        || case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) then 'C' else '' end
        || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
        || case when doc_id > first then 'E' else '' end as fails
    from texts join firsts using (text) left join judged using (doc_id)
),
masks as (
    select part, fails, count(*) as n, count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic
    from failing group by all
),
steps as (
    select filter_order, step::int as step, substr(filter_order, step, 1) as l, substr(filter_order, 1, step - 1) as before
    from orders, range(1, 6) t(step)
),
fates as (
    select *, contains(fails, l) as now, length(translate(fails, before, '')) < length(fails) as earlier from masks, steps
),
counted as (
    select part, filter_order, step, l,
        coalesce(sum(n) filter (not now and not earlier), 0)::bigint as kept,
        coalesce(sum(n) filter (now and not earlier), 0)::bigint as removed,
        coalesce(sum(n) filter (now and earlier), 0)::bigint as redundant,
        coalesce(sum(n) filter (fails = l), 0)::bigint as unique_fails,
        coalesce(sum(n_good) filter (now and not earlier), 0)::bigint as good_lost,
        coalesce(sum(n_toxic) filter (now and not earlier), 0)::bigint as toxic_lost
    from fates group by all
)
select * exclude (l), (sum(removed) over (partition by part, l))::bigint as shapley from counted"""

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op4_license_scan": OP4,
    "op5_substring_dedup": OP5,
    "op6_line_dedup": OP6,
    "op11_vector_codes": OP11,
    "op13_filter_audit": OP13,
}
