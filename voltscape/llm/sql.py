"""DuckDB SQL for the operators that SQL can express. Constants are written out here on purpose."""

from __future__ import annotations

from voltscape.llm import licenses

OP1 = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as draw
    from documents
),
sources as (
    select source, sum(size)::bigint as source_size,
        row_number() over (order by source asc nulls last) as idx
    from sized group by source
),
weighted as (select *, ((idx - 1) % 3 + 1)::bigint as weight, source_size * 3 as cap from sources),
stepped as (
    select *, ((select sum(source_size) from sources)::double
        - coalesce(sum(cap) over (order by cap / weight, idx rows between unbounded preceding and 1 preceding), 0)::double)
        / (sum(weight) over (order by cap / weight, idx rows between current row and unbounded following))::double as step
    from weighted
),
targets as (
    select source, source_size, idx, least(weight::double * (select max(step) from stepped), cap::double) as target,
        ((('0x' || substr(md5('0/' || coalesce(source, '')), 1, 8))::bigint * 1000000000) // 4294967296)::hugeint as offs
    from stepped
),
placed as (
    select s.doc_id, s.source, s.size, t.source_size, t.target, t.idx, t.offs, s.draw,
        coalesce(floor(least(t.target / nullif(t.source_size, 0), 3) * 1000000000), 0)::bigint as each,
        case when s.size < 16 then s.size else length(bin(s.size)) * 16 + (s.size >> (length(bin(s.size)) - 4)) end as class
    from sized s join targets t on s.source is not distinct from t.source
),
summed as (
    select *, offs + coalesce(sum(each) over (
        partition by idx order by class, draw, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
    from placed
)
select doc_id, source, size, source_size, target,
    ((before + each) // 1000000000 - before // 1000000000)::bigint as copies,
    ((before + each) // 1000000000 - before // 1000000000)::bigint * size as taken
from summed
"""

OP2 = r"""
with parts as (
    select page_id, html, list_filter(string_split(lower(regexp_extract(url, '^(?:[a-z]+:)?//(?:[^/?#]*@)?([^/?#:]*)', 1)), '.'), lambda x: x <> '') as labels,
        regexp_extract(url, '^(?:[a-z]+:)?//[^/?#]*([^?#]*)', 1) as path, regexp_extract(url, '[?]([^#]*)', 1) as query
    from pages
),
hashed as (
    select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as hex,
        array_to_string(list_reverse(case when labels[1] = 'www' and len(labels) > 2 then labels[2:] else labels end), ',') || ')'
            || case when path = '' then '/' else path end || case when query = '' then '' else '?' || query end as url_key,
        strftime(timestamp '2024-01-01' + to_seconds(page_id % 94608000), '%Y%m%d%H%M%S') as timestamp
    from parts
),
digests as (
    select page_id, payload_bytes, hex, url_key, timestamp, (
        select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            (((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))) & 31) + 1)::bigint, 1), '' order by i)
        from range(0, 32) t(i)) as payload_digest
    from hashed
),
firsts as (select hex, min(page_id) as first_page from digests group by hex)
select page_id, payload_bytes, payload_digest,
    case when first_page is null or page_id = first_page then 'response' else 'revisit' end as record_type,
    case when page_id = first_page then null else first_page end as refers_to, url_key, timestamp,
    row_number() over (partition by url_key order by timestamp, page_id::varchar) as place
from digests join firsts using (hex)
"""

OP5 = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized as (
    select *, role = 'assistant' as reply, row_number() over w as pos,
        sum(length(regexp_replace(text, '(<<|<|\[)(\\*)(/?(?:s>|INST\]|SYS>>))', '\1\\\2\3', 'g')) + length(role) + 8) over w as upto
    from turns window w as (partition by conv_id order by turn, role, text rows unbounded preceding)
),
ends as (
    select conv_id, max(pos) as last_pos, max(upto) as total, coalesce(max(pos) filter (where reply), 0) as last_reply from sized group by conv_id
)
select s.conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
    coalesce(sum(length(text)) filter (where reply), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by pos) filter (where reply), '')) as loss_sha256,
    (coalesce(sum(upto) filter (where reply), 0) + case when any_value(last_reply < last_pos) then any_value(total) else 0 end)::bigint as formatted_chars
from sized s join ends e on s.conv_id is not distinct from e.conv_id group by s.conv_id
"""


def _canonical(text: str) -> str:
    plain = (
        f"translate(regexp_replace({text}, '(?mi)^[ \\t]*((copyright|\\(c\\)|©)[^\\n]*[0-9]{{4}}"
        "|copyright[ \\t:]+(\\(c\\)|©|<|\\[yyyy\\]|\\{yyyy\\}|by[ \\t]))[^\\n]*$', ' ', 'g'), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    found = f"' ' || regexp_replace({plain}, '[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+', '  ', 'g') || ' '"
    for old, new in licenses.SPELLINGS:
        found = f"replace({found}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return f"trim(replace({found}, '  ', ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in (*licenses.TEXTS, *licenses.NOTICES))
OP8 = f"""
with known as (
    select sha256({_canonical('text')}) as digest, min(license_id) as license_id
    from (values {_KNOWN}) as t(license_id, text) group by 1
),
docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
lines as (select r, unnest(string_split(text, chr(10))) as line from docs),
cited as (
    select r, string_agg(distinct license_id, ',' order by license_id) as line_licenses, count(*) as n
    from (select r, sha256({_canonical('line')}) as digest from lines) join known using (digest) group by r
)
select doc_id, digest, license_id, coalesce(line_licenses, '') as line_licenses, coalesce(n, 0)::bigint as n_license_lines
from (select *, sha256({_canonical('text')}) as digest from docs) left join known using (digest) left join cited using (r)
"""

_CRC32 = """(xor(list_reduce(
    [4294967295::bigint] || flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0])),
    lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384::bigint * (xor(crc, byte) & 1))), 4294967295::bigint))"""

OP12 = f"""
with said as (
    select conv_id, turn, coalesce(text, '') as text,
        length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '') as said
    from conversations where conv_id is not null
),
own as (
    select conv_id, list(md5(said) order by turn asc nulls first, md5(said)) as digests,
        list(length(text)::bigint order by turn asc nulls first, md5(said)) as lengths
    from said group by conv_id
),
led as (select *, {_CRC32.format(text='conv_id::varchar')} % 6 as h, conv_id - conv_id % 100 as leader from own),
rebuilt as (
    select o.conv_id, coalesce(l.digests[1:o.h], []) || o.digests[o.h + 1:] as digests,
        coalesce(l.lengths[1:o.h], []) || o.lengths[o.h + 1:] as lengths
    from led o left join own l on l.conv_id = o.leader
),
prefixes as (
    select conv_id, len(digests) as turns, unnest(range(0, len(digests) + 1)) as depth, digests, lengths from rebuilt
),
nodes as (
    select array_to_string(digests[1:depth], '') as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
        max(coalesce(lengths[depth], 0)) as held,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (turns = depth), '') as ends
    from prefixes group by all
),
families as (select substr(path, 1, 32 * (depth - 1)::int) as path, count(*) as n_children from nodes where depth > 0 group by 1),
known as (select n.*, coalesce(f.n_children, 0) as n_children from nodes n left join families f on n.path = f.path),
above as (
    select path, n_children, (n_convs - 1) * case when depth = 0 then 0 else held end as saved,
        unnest(range(0, depth + 1)) as up from known
),
totals as (
    select substr(path, 1, (32 * up)::int) as path, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved_tokens
    from above group by 1
)
select n.conv_id::bigint as conv_id, n.depth::bigint as depth, p.conv_id::bigint as parent_conv_id, n.n_convs::bigint as n_convs,
    n.n_children::bigint as n_children, t.n_leaves::bigint as n_leaves, t.saved_tokens::bigint as saved_tokens,
    sha256(n.ends) as ends_sha256
from known n join totals t on n.path = t.path
    left join nodes p on n.depth > 0 and p.path = substr(n.path, 1, 32 * (n.depth - 1)::int)
"""

OP13 = r"""
with docs as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
),
words as (select r, lang, source, unnest(terms) as term from docs),
kept as (select lang, term from words group by lang, term having count(distinct r) >= 3),
counts as (select w.lang, w.source, w.term, count(*) as n from words w join kept k on w.lang = k.lang and w.term = k.term group by all),
groups as (
    select g.lang, g.source, coalesce(v.v, 0) as v, coalesce(c.n, 0) as n
    from (select distinct lang, source from docs) g
        left join (select lang, count(*) as v from kept group by lang) v on v.lang = g.lang
        left join (select lang, source, sum(n) as n from counts group by all) c on c.lang = g.lang and c.source = g.source
),
given as (
    select g.lang, g.source, k.term, coalesce(c.n, 0)::bigint as n,
        (1 + (1000000000 * (coalesce(c.n, 0) + 1)::hugeint) // (g.n + g.v))::bigint as p
    from groups g join kept k on k.lang = g.lang
        left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
whole as (
    select c.lang, c.term, (1 + (1000000000 * (sum(c.n) + 1)::hugeint) // (any_value(t.n) + any_value(t.v)))::bigint as p
    from counts c join (select lang, sum(n) as n, max(v) as v from groups group by lang) t on t.lang = c.lang
    group by c.lang, c.term
),
sums as (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from given a join given b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
),
terms as (
    select g.lang, g.source, 'term' as part, g.term as item, ((g.p - w.p) * (g.p - w.p)) // w.p as value
    from given g join whole w on w.lang = g.lang and w.term = g.term where g.n > 0 and g.p > w.p
)
select lang, source, part, item, value,
    (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from (select * from pairs union all select * from terms) qualify part = 'pair' or rank <= 200
"""

ORACLES: dict[str, str] = {
    "op1_mix_sources": OP1,
    "op2_warc": OP2,
    "op5_chat": OP5,
    "op8_licenses": OP8,
    "op12_prefix_trie": OP12,
    "op13_divergence": OP13,
}
