"""DuckDB SQL for the results of the corpus queries."""

from __future__ import annotations

from opsgrain.llm import decontaminate, filter_audit, hard_negatives, line_dedup, quality, substrings

_WORD = r"'[^\x20\x09-\x0D]+'"

_VALUES = ", ".join(
    f"case when {down} > 0 then least({quality.TOP}, {scale} * {up} // {down}) else 0 end as v_{rule}"
    for rule, (up, down, scale) in quality.RULES.items())

QUALITY_CTES = rf"""
texts as (select doc_id, lang, coalesce(text, '') as text from documents),
w as (select doc_id, lang, text, regexp_extract_all(text, {_WORD}) as words,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, {_WORD})) as lines from texts),
keyed as (select row_number() over () as r, * from w),
tri as (select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as t
        from (select r, words, unnest(range(1, len(words) - 1)) as i from keyed where len(words) > 2)),
hit as (select r, i from (select r, i, count(*) over (partition by r, t) as n from tri) where n > 1),
rep as (select r, count(distinct i + d) as n from hit, (values (0), (1), (2)) as o(d) group by r),
m as (select k.r, doc_id, coalesce(lang, '') as stratum, len(words) as n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, len(lines) as n_lines,
             length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_upper
      from keyed k left join rep on rep.r = k.r),
v as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed, {_VALUES} from m),
marks as (select doc_id, min(quality) > 0 as clean from labels where doc_id is not null and quality is not null group by doc_id),
held as (select v.*, clean from v join marks on marks.doc_id = v.doc_id where not base_failed),
cells as ({" union all ".join(f"select stratum, '{r}' as rule, v_{r} as value, clean from held" for r in quality.RULES)}),
counts as (select stratum, rule, value, count(*) filter (clean) as c, count(*) filter (not clean) as b from cells group by all),
sums as (select stratum, rule, sum(c)::bigint as n, sum(b)::bigint as bad,
                {quality.DELTA} / ({len(quality.RULES)} * (select count(distinct stratum) from counts)) as delta from counts group by all),
sizes as (select distinct n, delta from sums),
tails as (select n, j, delta, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({quality.RISK / len(quality.RULES)!r})
                 + (n - j) * ln(1 - {quality.RISK / len(quality.RULES)!r}))) over (partition by n order by j) as tail
          from (select n, delta, unnest(range(0, n + 1)) as j from sizes)),
limits as (select n, max(j) as k from tails where tail <= delta group by n),
cums as (select stratum, rule, value, sum(c) over w as k, sum(b) over w as caught from counts window w as (partition by stratum, rule order by value desc)),
picked as (select stratum, rule, arg_max(value - 1, (caught / bad - cums.k / n, value)) as cutoff
           from cums join sums using (stratum, rule) join limits using (n)
           where cums.k <= limits.k and bad > 0 and caught / bad - cums.k / n > 0 group by all),
cuts as (select stratum, {", ".join(f"max(cutoff) filter (rule = '{r}') as cut_{r}" for r in quality.RULES)} from picked group by stratum),
judged as (select v.*, not base_failed{"".join(f" and coalesce(v_{r} <= cut_{r}, true)" for r in quality.RULES)} as kept
           from v left join cuts using (stratum))"""

QUALITY = f"""with {QUALITY_CTES}
select doc_id, n_words::bigint as n_words, word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
       n_repeat_words::bigint as n_repeat_words, base_failed, kept from judged"""

SHARDS = r"""with t as (select doc_id, coalesce(text, '') as text from documents),
k as (select doc_id, text, strlen(text) + 1 as size, ('0x' || substr(md5(text), 1, 15))::bigint as h from t),
c as (select *, coalesce(sum(size) over (order by h, doc_id nulls first rows between unbounded preceding and 1 preceding), 0) as before,
             sum(size) over () as total from k),
s as (select *, (select count(*) from range(1, 8) as i(i) where before >= (total * i.i + 7) // 8)::int as shard from c),
x as (select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as tab),
crc as (select text, xor(list_reduce(list_transform(regexp_extract_all(hex(text), '..'), lambda p: ('0x' || p)::bigint),
               lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as crc
        from (select distinct text from t), x)
select doc_id, size::bigint as size, crc.crc::bigint as text_crc32, 'bytes' as law, shard,
       row_number() over (partition by shard order by h, doc_id nulls first) - 1 as slot, null::int as grown_shard from s join crc using (text)"""

LINES = rf"""with t as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
l as (select r, i, lines[i] as line, trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare, source
      from (select r, source, string_split(text, chr(10)) as lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from t)),
wide as (select bare from l where bare <> '' group by bare having count(distinct source) >= {line_dedup.MIN_SITES}),
f as (select l.*, wide.bare is not null as bad from l left join wide using (bare)),
d as (select r, count(*) filter (bare <> '') as n_lines, count(*) filter (bad) as n_widespread,
             string_agg(line, chr(10) order by i) filter (not bad) as kept from f group by r)
select doc_id, n_lines, n_widespread, n_widespread as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from t join d using (r)"""

REPEATS = rf"""with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) as w from documents),
win as (select r, i, md5(array_to_string(w[i : i + {substrings.LENGTH - 1}], ' ')) as s
        from (select r, w, unnest(range(1, len(w) - {substrings.LENGTH} + 2)) as i from d)),
dup as (select r, i from (select r, i, count(*) over (partition by s) as n from win) where n > 1),
gone as (select distinct r, i + o as p from dup, range(0, {substrings.LENGTH}) as o(o)),
words as (select r, p, w[p] as word from (select r, w, unnest(range(1, len(w) + 1)) as p from d)),
kept as (select words.r, count(*) as n_kept, string_agg(word, ' ' order by words.p) as kept
         from words anti join gone on gone.r = words.r and gone.p = words.p group by words.r)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n_kept, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (r)"""

CONTAINMENT = rf"""with item as (select distinct item_id, coalesce(text, '') as text from benchmark),
iw as (select item_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') as w from item),
ik as (select *, least({decontaminate.WIDTH}, len(w)) as width from iw where len(w) > 0),
its as (select distinct item_id, text, width, w[i : i + width - 1] as s from (select *, unnest(range(1, len(w) - width + 2)) as i from ik)),
n as (select item_id, text, count(*) as n from its group by all),
dw as (select doc_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') as w from (select distinct doc_id, coalesce(text, '') as text from documents)),
ds as (select distinct doc_id, text, w[i : i + width - 1] as s
       from (select *, unnest(range(1, len(w) - width + 2)) as i from dw, (select distinct width from ik))),
c as (select ds.doc_id, ds.text as dt, its.item_id, its.text as it, count(*) as n_shared from ds join its on ds.s = its.s group by all)
select distinct doc_id, c.item_id, n.n as n_shingles, n_shared, n_shared / n.n as containment
from c join n on n.item_id is not distinct from c.item_id and n.text = c.it where n_shared * 100 >= n.n * {decontaminate.PERCENT}"""


NEGATIVES = f"""with v as (select vec_id, case when vec_id % {hard_negatives.NOISY} = 0 then (label + 1) % {hard_negatives.LABELS} else label end as label,
  list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::double)) as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, list_inner_product(a.e, v.e)::bigint as score
      from v as a, v where a.vec_id % {hard_negatives.EVERY} = 0 and a.vec_id <> v.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {hard_negatives.POSITIVES}),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank
      from p join s using (anchor_id) where not same and {hard_negatives.LOW} * positive_score <= 100 * s.score and 100 * s.score <= {hard_negatives.HIGH} * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= {hard_negatives.NEGATIVES}"""

_BITS = ", ".join(f"('{name}', {1 << i})" for i, name in enumerate(filter_audit.FILTERS))

AUDIT = rf"""with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
                   min(doc_id) over (partition by coalesce(text, '')) as first_id from documents),
w as (select *, regexp_extract_all(text, {_WORD}) as words from t),
marks as (select doc_id, max((quality is not null and quality = 1)::int) as good, max((toxic is not null and toxic = 1)::int) as toxic
          from labels where doc_id is not null group by doc_id),
f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
             (len(words) < {filter_audit.MIN_WORDS})::int + 2 * (100 * len(list_distinct(words)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(words))::int
             + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {filter_audit.MAX_UPPER_PERCENT} * length(text))::int
             + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * (doc_id is not null and first_id < doc_id)::int as fails
      from w left join marks using (doc_id)),
g as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
b(name, bit) as (values {_BITS}),
o as (select a.name || b2.name || c.name || d.name || e.name as filter_order from b a, b b2, b c, b d, b e
      where a.bit + b2.bit + c.bit + d.bit + e.bit = 31 and a.bit | b2.bit | c.bit | d.bit | e.bit = 31),
st as (select filter_order, step::int as step, bit, (select coalesce(sum(x.bit), 0) from b x where contains(substr(filter_order, 1, step - 1), x.name)) as before
       from o, range(1, 6) as r(step), b where b.name = substr(filter_order, step, 1)),
r as (select part, filter_order, step, bit,
             sum(n) filter (fails & (before | bit)::int = 0) as kept, sum(n) filter (fails & before::int = 0 and fails & bit <> 0) as removed,
             sum(n) filter (fails & before::int <> 0 and fails & bit <> 0) as redundant, sum(n) filter (fails = bit) as unique_fails,
             sum(good) filter (fails & before::int = 0 and fails & bit <> 0) as good_lost, sum(toxic) filter (fails & before::int = 0 and fails & bit <> 0) as toxic_lost
      from g, st group by all)
select part, filter_order, step, substr(filter_order, step, 1) as filter, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
       coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
       coalesce(toxic_lost, 0)::bigint as toxic_lost, (sum(coalesce(removed, 0)) over (partition by part, bit))::bigint as shapley from r"""
