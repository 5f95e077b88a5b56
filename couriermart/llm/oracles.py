"""SQL of the queries that SQL can express."""

MIX_SOURCES = r"""
with rows as (
    select doc_id, source,
        cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
        substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 12) as hash
    from documents
), sizes as (
    select source, cast(sum(size) as bigint) as source_size from rows group by source
), weighed as (
    select *, cast([3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as double) as weight,
        source_size * 2.0e0 as cap
    from sizes
), leveled as (
    select *, cap / weight as fills_at,
        (sum(source_size) over () * 1.5e0 - coalesce(sum(cap) over earlier, 0))
            / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as level
    from weighed
    window earlier as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
), opened as (
    select min(struct_pack(f := fills_at, l := level)) as o from leveled where fills_at >= level
), targets as (
    select source, source_size, case when o is null then cap else least(cap, o.l * weight) end as target
    from leveled, opened
), parts as (
    select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole
    from targets
), ordered as (
    select r.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as budget,
        sum(r.size) over (partition by r.source order by r.hash range between unbounded preceding and current row) as upto,
        sum(r.size) over (partition by r.source, r.hash) as own,
        count(*) over (partition by r.source, r.hash) as alike, row_number() over (partition by r.source, r.hash) as nth
    from rows r join parts p on r.source is not distinct from p.source
)
select doc_id, size, source_size, target,
    cast(size * (whole + case when budget <= 0 then 0 when upto < budget then 1
        when upto - own < budget and nth <= ceil((budget - (upto - own)) * alike / own - 0.5e0) then 1 else 0 end) as bigint) as taken
from ordered
"""

_CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped(text: str) -> str:
    text = rf"replace({text}, '\', '\\')"
    for control in _CONTROLS:
        text = rf"replace({text}, '{control}', '{control[0]}\{control[1:]}')"
    return text


FORMAT_CHATS = f"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), joined as (
    select conv_id, count(*) as n_turns,
        coalesce(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text), '') as turns,
        coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
        cast(sum(32 + length({_escaped("role")}) + length({_escaped("text")})) as bigint) as formatted_chars
    from rows group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(loss) as bigint) as loss_chars,
    sha256(loss) as loss_sha256, formatted_chars
from joined
"""

FILTER_URLS = r"""
with captures as (
    select page_id, url, timestamp '2024-01-01' + to_days(cast(page_id % 366 as int)) + to_hours(page_id % 24) as fetched_at,
        lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)', 1)) as host
    from pages
), named as (
    select distinct 'adult' as list, 'host' as kind, host as key from captures where host <> ''
    union select 'malware', 'domain', array_to_string(string_split(host, '.')[-2:], '.') from captures where host <> ''
    union select 'takedown', 'url', string_split(url, '#')[1] from captures
), marked as (
    select *, cast('0x' || substr(md5(key), 1, 5) as int) as h from named where key is not null
), events as (
    select list, kind, key, timestamp '2024-01-01' + to_days(h % 300) as since, true as active from marked where h % 4 = 0
    union all
    select list, kind, key, timestamp '2024-01-01' + to_days(h % 300 + 20 + h % 50), false from marked where h % 4 = 0 and h % 3 = 0
    union all
    select list, kind, key, timestamp '2024-01-01' + to_days(h % 300 + 90), true from marked where h % 4 = 0 and h % 5 = 0
), intervals as (
    select *, lead(since) over (partition by list, kind, key order by since) as until from events
), hits as (
    select c.page_id, i.list from captures c join intervals i on i.active and c.fetched_at >= i.since
        and (i.until is null or c.fetched_at < i.until)
        and ((i.kind = 'host' and i.key = c.host)
            or (i.kind = 'url' and i.key = string_split(c.url, '#')[1])
            or (i.kind = 'domain' and (i.key = c.host or suffix(c.host, '.' || i.key))))
), verdicts as (
    select page_id, count(*) as n_entries, string_agg(distinct list, ',' order by list) as lists from hits group by page_id
)
select c.page_id, c.fetched_at, c.host, coalesce(v.n_entries, 0) as n_entries, coalesce(v.lists, '') as lists,
    v.page_id is not null as blocked
from captures c left join verdicts v on c.page_id = v.page_id
"""

WARC = """
with hashed as (
    select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), grouped as (
    select *, min(page_id) over (partition by payload_digest) as first_id from hashed
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from grouped
"""

TOPK = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v
    from embeddings
    where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

FILTER_AUDIT = r"""
with recursive texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), firsts as (
    select text, min(doc_id) as first_id from texts group by text
), known as (
    select doc_id, max(coalesce(quality, 0) = 1) as good, max(coalesce(toxic, 0) = 1) as toxic from labels group by doc_id
), failing as (
    select t.part, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic,
        (len(t.words) < 200) as a,
        (100 * len(list_distinct(t.words)) < 50 * len(t.words)) as b,
        (100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 3 * length(t.text)) as c,
        regexp_matches(t.text, '[#$%&*|]') as d,
        coalesce(t.doc_id > f.first_id, false) as e
    from texts t join firsts f using (text) left join known l on t.doc_id = l.doc_id
), listed as (
    select part, good, toxic, concat(case when a then 'A' else '' end, case when b then 'B' else '' end,
        case when c then 'C' else '' end, case when d then 'D' else '' end, case when e then 'E' else '' end) as fails,
        count(*) as n
    from failing group by all
), orders(o) as (
    select '' union all select o || x from orders, (values ('A'), ('B'), ('C'), ('D'), ('E')) v(x) where not contains(o, x)
), steps as (
    select o as filter_order, cast(s as integer) as step, substr(o, 1, s - 1) as before, substr(o, s, 1) as letter
    from orders, range(1, 6) r(s) where length(o) = 5
), met as (
    select part, filter_order, step, letter, n, good, toxic, fails,
        before <> '' and regexp_matches(fails, '[' || before || '_]') as gone, contains(fails, letter) as hit
    from listed, steps
), counted as (
    select part, filter_order, step, letter,
        cast(sum(case when not gone and not hit then n else 0 end) as bigint) as kept,
        cast(sum(case when not gone and hit then n else 0 end) as bigint) as removed,
        cast(sum(case when gone and hit then n else 0 end) as bigint) as redundant,
        cast(sum(case when fails = letter then n else 0 end) as bigint) as unique_fails,
        cast(sum(case when not gone and hit and good then n else 0 end) as bigint) as good_lost,
        cast(sum(case when not gone and hit and toxic then n else 0 end) as bigint) as toxic_lost
    from met group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from counted
"""
