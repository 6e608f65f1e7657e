"""SQL for the queries that SQL can express, over the same tables.

No SQL: op4 (approximate), op5 (a tree per page), op6 and op8 (checksums, tokenizer), op9 (the battery's thresholds),
op11 (eigenvectors);
these are tested against plain Python in ``tests/llm``.
"""

from __future__ import annotations

WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
with rows as (select doc_id, source, len({WORDS})::bigint as size,
    md5('mix-1:' || coalesce(doc_id::varchar, '')) as turn from documents),
sources as (select source, sum(size)::bigint as source_size,
    row_number() over (order by (source is null)::int, source) - 1 as rank from rows group by 1),
weighed as (select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end as w from sources),
total as (select sum(source_size)::bigint as budget, sum(w) as ws from weighed),
-- Sources are capped in the order of what they can give for their weight.
steps as (select *, coalesce(sum(3 * source_size) over o, 0) as used, coalesce(sum(w) over o, 0) as gone
    from weighed, total
    window o as (order by 3.0 * source_size / w, rank rows between unbounded preceding and 1 preceding)),
rate as (select (budget - used)::double / (ws - gone)::double as rate from steps
    where (budget - used)::double / (ws - gone)::double * w <= 3 * source_size
    order by 3.0 * source_size / w, rank limit 1),
targets as (select weighed.*, least((3 * source_size)::double, rate * w) as target from weighed, rate),
queued as (select rows.*, rank, source_size, target, sum(size) over (partition by rank order by turn, doc_id, size
    rows between unbounded preceding and current row) as upto
    from rows join targets on rows.source is not distinct from targets.source),
copies as (select *, (r * source_size + upto)::double / target as finish from queued, (select unnest([0, 1, 2]) as r)
    where size > 0 and target > 0),
lined as (select *, coalesce(sum(size) over (order by finish, rank, r, upto
    rows between unbounded preceding and 1 preceding), 0) as before from copies),
taken as (select rank, upto, size, count(*) as n from lined, total where 2 * before + size <= 2 * budget group by 1, 2, 3)
select doc_id, q.size, source_size::bigint as source_size, target, (coalesce(n, 0) * q.size)::bigint as taken
from queued q left join taken t on q.size > 0 and q.rank = t.rank and q.upto = t.upto
"""


def op2(blocked: tuple[str, ...]) -> str:
    names = ", ".join(f"'{b}'" for b in blocked)
    ends = " or ".join(f"ends_with(host, '.{b}')" for b in blocked)
    fits = "(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    return f"""
with rests as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rests),
ruled as (select *, case when {fits.format(h='example.net', p='/en/')} then 'example.net/en/'
    when {fits.format(h='example.com', p='/de/')} then 'example.com/de/'
    when {fits.format(h='org', p='/fr/')} then 'org/fr/' when {fits.format(h='net', p='/')} then 'net/' end as rule
    from parts)
select *, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
    when host in ({names}) or {ends} then 'block' else 'allow' end as verdict from ruled
"""


OP3 = f"""
with w as (select row_number() over () as k, doc_id, {WORDS} as words from documents),
windows as (select k, i, array_to_string(words[i:i + 34], ' ') as win
    from (select k, words, unnest(range(1, len(words) - 33)) as i from w where len(words) >= 35)),
twice as (select win from windows group by 1 having count(*) > 1),
gone as (select k, list(distinct p) as places from (
    select k, unnest(range(i, i + 35)) as p from windows semi join twice using (win)) group by 1),
place as (select k, p from gone, unnest(places) as u(p)),
kept as (select w.k, string_agg(words[i], ' ' order by i) as kept from
    (select k, words, unnest(range(1, len(words) + 1)) as i from w) w
    anti join place on w.k = place.k and w.i = place.p group by 1)
select doc_id, len(words)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from w left join gone using (k) left join kept using (k)
"""

OP7 = f"""
with w as (select row_number() over () as k, doc_id, coalesce(text, '') as text, {WORDS} as words from documents),
windows as (select k, i, array_to_string(words[i:i + 7], ' ') as win
    from (select k, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8)),
twice as (select k, i from windows qualify count(*) over (partition by k, win) > 1),
repeated as (select k, count(distinct p) as n from (select k, unnest(range(i, i + 8)) as p from twice) group by 1),
lines as (select k, list_filter(string_split(text, chr(10)),
    lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from w),
m as (select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
    len(lines) as n_lines from w join lines using (k) left join repeated using (k)),
f as (select *, ((n_words < 20)::int + 2 * (100 * n_repeat_words > 30 * n_words)::int
    + 4 * (n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines)::int + 8 * (10 * n_symbols > n_words)::int
    + 16 * (word_chars < 2 * n_words)::int + 32 * (word_chars > 15 * n_words)::int)::bigint as failed from m)
select * exclude (n_lines), n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, failed = 0 as kept from f
"""

OP10 = f"""
with recursive w as (select doc_id, {WORDS.replace('text', LOWER)} as words from documents),
shingles as (select distinct doc_id, case when len(words) < 3 then array_to_string(words, ' ')
    else array_to_string(words[i:i + 2], ' ') end as s
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) as i from w where len(words) > 0)),
sizes as (select doc_id, count(*)::bigint as n from shingles group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b using (s)
    where a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * c >= 90 * (x.n + y.n - c)),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, (select min(b) from reach where a = w.doc_id) as component_id
from w left join sizes using (doc_id)
"""

TERMS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
with d as (select row_number() over () as k, doc_id, {TERMS} as terms from documents),
q as (select row_number() over () as i, item_id, unnest(list_distinct({TERMS})) as term from benchmark),
postings as (select k, term, count(*) as tf from (select k, unnest(terms) as term from d) group by 1, 2),
total as (select count(*) as docs, sum(len(terms))::bigint as terms from d where len(terms) > 0),
weighed as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from postings, total group by 1),
lengths as (select k, doc_id, 50 + (50 * len(d.terms)::bigint * docs) // total.terms as m from d, total),
scores as (select i, item_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
    from q join weighed using (term) join postings using (term) join lengths using (k) group by 1, 2, 3),
ranked as (select item_id, row_number() over (partition by i order by score desc, doc_id)::int as rank, doc_id, score
    from scores join lengths using (k) where score > 0)
select * from ranked where rank <= 50
"""

# CRC-32, bit by bit, of the few digits of an id.
CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({c}::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda r, _: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)), 4294967295)"""

OP13 = f"""
with d as (select row_number() over () as k, doc_id, lang, coalesce({CRC32.format(c="doc_id")} % 4 = 2, false) as held_out,
    text from documents),
words as (select k, ' ' || w || ' ' as w, count(*) as n
    from (select k, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) as w from d) group by 1, 2),
grams as (select k, gram, sum(n) as n from (
    select k, n, unnest(list_concat(list_transform(range(2, length(w)), lambda i: w[i:i]),
        list_transform(range(1, length(w)), lambda i: w[i:i + 1]),
        list_transform(range(1, length(w) - 1), lambda i: w[i:i + 2]))) as gram from words) group by 1, 2),
profiles as (select lang, gram, row_number() over (partition by lang order by sum(n) desc, gram) as rank
    from grams join d using (k) where not held_out and lang is not null group by 1, 2 qualify rank <= 300),
own as (select k, gram, row_number() over (partition by k order by n desc, gram) as rank from grams qualify rank <= 300),
gained as (select k, lang, sum(300 - abs(own.rank - profiles.rank)) as gain from own join profiles using (gram) group by 1, 2),
best as (select k, (300 * m - coalesce(gain, 0))::double as distance, lang, (300 * m)::double as most
    from (select k, count(*) as m from own group by 1) cross join (select distinct lang from profiles)
    left join gained using (k, lang)
    qualify row_number() over (partition by k order by 300 * m - coalesce(gain, 0), lang) = 1)
select doc_id, held_out, coalesce(best.lang, 'und') as lang_pred, coalesce(1.0 - distance / most, 0.0) as score
from d left join best using (k)
"""
