"""The same results in plain DuckDB SQL, for the operators that SQL can express."""

MIXING = r"""
with recursive docs as (
  select doc_id, source, md5('mix:' || doc_id) as k,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '')) as size
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][1 + ((row_number() over (order by source is null, source) - 1) % 3)::int] as weight
  from docs group by source
), capped as (select *, 3 * source_size as cap, 3 * source_size / weight as rate from sources),
-- a source is at its cap if sharing by weight what the smaller rates leave would lift it above
levels as (
  select a.rate, (select sum(source_size) from sources) - coalesce((select sum(b.cap) from capped b where (b.rate, coalesce(b.source, '~~')) < (a.rate, coalesce(a.source, '~~'))), 0) as rest,
         (select sum(b.weight) from capped b where (b.rate, coalesce(b.source, '~~')) >= (a.rate, coalesce(a.source, '~~'))) as weights
  from capped a
), level as (select min_by(rest / weights, rate) as l from levels where rate > rest / weights),
aims as (select source, source_size, least(cap::double, weight * (select l from level)) as target from capped),
placed as (
  select d.doc_id, d.size, d.k, a.source_size, a.target,
         sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size) as upto
  from docs d join aims a on d.source is not distinct from a.source
), queue as (
  select *, coalesce((upto + source_size * t) / nullif(target, 0), 0) as finish from placed, range(3) turns(t)
), taken as (
  select doc_id, size, sum(size) over (order by finish, k, doc_id, size, t) as spent from queue
)
select p.doc_id, p.size, p.source_size, p.target,
       coalesce((select sum(t.size) from taken t where t.doc_id = p.doc_id and t.spent <= (select sum(size) from docs)), 0)::bigint as taken
from placed p
"""

PASSAGES = r"""
with docs as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') as w from documents
), starts as (
  select doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from docs where len(w) >= 50)
), later as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as least from starts) where least < doc_id
), gone as (select distinct doc_id, unnest(range(i, i + 50)) as i from later),
removed as (select doc_id, list(i) as at, count(*) as n from gone group by doc_id),
kept as (
  select d.doc_id, len(d.w) as n_words, coalesce(r.n, 0) as n_removed, d.w,
         case when r.n is null then [true for x in d.w] else null end as whole, r.at
  from docs d left join removed r using (doc_id)
), flat as (
  select k.doc_id, string_agg(u.word, ' ' order by u.i) as t
  from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from kept) u join kept k using (doc_id)
  where not exists (select 1 from gone g where g.doc_id = u.doc_id and g.i = u.i)
  group by k.doc_id
)
select k.doc_id, k.n_words::bigint as n_words, k.n_removed::bigint as n_removed, sha256(coalesce(f.t, '')) as kept_sha256
from kept k left join flat f using (doc_id)
"""

QUALITY = r"""
with docs as (
  select doc_id, lang, source, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i : i + 7], ' ') as h
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from docs where len(w) >= 8)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, h) as n from windows) where n > 1
), repeated as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id
), lines as (
  select doc_id, count(*) - count(distinct x) as n, count(*) as n_all from (select doc_id, unnest(string_split(t, chr(10))) as x from docs)
  where regexp_matches(x, '[^ \t-\r]') group by doc_id
), measured as (
  select d.doc_id, d.lang, d.source, len(d.w)::bigint as n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g'))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         coalesce(l.n, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
         (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g'))) as n_capitals, l.n_all as n_lines,
         len(list_filter(d.w, lambda x, i: i > 1 and x = d.w[i - 1])) as n_echoes
  from docs d left join lines l using (doc_id) left join repeated r using (doc_id)
), rated as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
         coalesce(n_symbols / nullif(n_words, 0), 0) as a, coalesce(n_capitals / nullif(word_chars, 0), 0) as b,
         coalesce(word_chars / nullif(n_words, 0), 0) as c, coalesce(n_dup_lines / nullif(n_lines, 0), 0) as d,
         coalesce(n_echoes / nullif(n_words, 0), 0) as e
  from measured
), long as (select doc_id, lang, source, n_words, unnest(['a', 'b', 'c', 'd', 'e']) as rate, unnest([a, b, c, d, e]) as x,
  unnest([0.05, 0.05, 0.5, 0.1, 0.05]) as spread from rated),
quartiles as (
  select lang, source, rate, any_value(spread) as spread, grouping(lang, source) as wide, count(*) as n,
         quantile_disc(x, 0.25) as q1, quantile_disc(x, 0.75) as q3
  from long where n_words >= 20 group by grouping sets ((rate, lang, source), (rate, lang), (rate))
), choice as (
  select l.doc_id, l.x, min_by(struct_pack(q1 := q.q1, q3 := q.q3, s := q.spread), q.wide) as f
  from long l left join quartiles q on l.rate = q.rate and (q.n >= 100 or q.wide = 3)
    and (q.wide = 3 or (l.lang is not distinct from q.lang and (q.wide = 1 or l.source is not distinct from q.source)))
  group by l.doc_id, l.rate, l.x
), verdict as (
  select doc_id, bool_and(coalesce(x between f.q1 - 6 * greatest(f.q3 - f.q1, f.s) and f.q3 + 6 * greatest(f.q3 - f.q1, f.s), true)) as fits
  from choice group by doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and fits as kept
from rated join verdict using (doc_id)
"""

SEARCH = r"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as own
  from documents
), sized as (select doc_id, own, len(own)::bigint as n from docs where len(own) > 0),
totals as (select count(*)::bigint as documents, sum(n)::bigint as length from sized),
placed as (select doc_id, 100 - 75 + ((75 * n * documents) // length) as m, own from sized, totals),
counted as (select doc_id, m, term, count(*)::bigint as tf from (select doc_id, m, unnest(own) as term from placed) group by all),
weights as (
  select term, floor(1000 * ln((2 * any_value(documents) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from counted, totals group by term
), items as (
  select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
  from benchmark
), scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from items join counted using (term) join weights using (term) group by item_id, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0
qualify rank <= 10
"""

LINES = r"""
with lines as (
  select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines
), judged as (
  select doc_id, line, i, length(k) >= 10 and min(doc_id) over (partition by k) < doc_id as gone from keyed
)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (gone))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

PREFIXES = r"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos,
         struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) as own
  from conversations where conv_id is not null
), convs as (
  select conv_id, list(own order by pos) as own,
         -- crc32, reflected: eight steps for each byte of the number in decimal
         xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, step: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end))) % 4 as h
  from turns group by conv_id
), rebuilt as (
  select c.conv_id, list_concat(coalesce(b.own, [])[1 : c.h], c.own[c.h + 1 :]) as turns
  from convs c left join convs b on b.conv_id = c.conv_id - c.conv_id % 20
), paths as (select conv_id, len(turns) as n, unnest(range(0, len(turns) + 1)) as depth, turns from rebuilt),
nodes as (
  select depth, turns[1 : depth] as path, min(conv_id) as conv_id, count(*)::bigint as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256,
         count(distinct turns[1 : depth + 1]) filter (n > depth) as n_children,
         case when depth = 0 then 0 else len(list_filter(regexp_split_to_array(any_value(turns)[depth].text, '[ \t-\r]+'), lambda w: w <> '')) end as words
  from paths group by depth, path
), below as (
  select t.depth, t.path, sum(case when b.n_children = 0 then 1 else 0 end)::bigint as n_leaves, sum((b.n_convs - 1) * b.words)::bigint as saved_tokens
  from nodes t join (select *, unnest(range(0, depth + 1)) as d from nodes) b on b.d = t.depth and b.path[1 : b.d] = t.path
  group by t.depth, t.path
)
select n.conv_id::bigint as conv_id, n.depth::bigint as depth, p.conv_id::bigint as parent_conv_id, n.n_convs, n.n_children::bigint as n_children,
       b.n_leaves, b.saved_tokens, n.ends_sha256
from nodes n join below b on n.depth = b.depth and n.path = b.path left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1 : n.depth - 1]
"""
