"""SQL that gives the rows of the queries whose method SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_RATIOS = {
    "symbols": ("n_symbols", "n_words", 0.05, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.2, False),
    "repeats": ("n_repeat_words", "n_words", 0.1, False),
    "word_length": ("word_chars", "n_words", 0.75, True),
}
_GAMMA = 1.01 / 0.99


def _quality(floors: bool) -> str:
    values = "\nunion all ".join(
        f"select lang, source, '{m}' as metric, case when {b} > 0 then {a} / {b} else 0.0 end::double "
        f"as x, {least}::double as least from counts where not base_failed"
        for m, (a, b, least, _) in _RATIOS.items())

    def whole_fences(keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
        select {by}n_rows, metric,
               q1 - 3 * case when q3 - q1 > 0.02::double * q3 then q3 - q1
                             else greatest(0.02::double * q3, least(most, q1 - p1)) end as low,
               q3 + 3 * case when q3 - q1 > 0.02::double * q3 then q3 - q1
                             else greatest(0.02::double * q3, least(most, p99 - q3)) end as high
        from (
          select {by}metric, any_value(least) as most, max(n_rows) as n_rows,
                 min(case when upto >= 0.25 * n_rows then x end) as q1,
                 min(case when upto >= 0.75 * n_rows then x end) as q3,
                 min(case when 100 * upto > n_rows then x end) as p1,
                 min(case when 100 * upto >= 99 * n_rows then x end) as p99
          from (
            select {by}metric, least, sum(n) over (partition by {by}metric order by bucket) as upto,
                   sum(n) over (partition by {by}metric) as n_rows,
                   case when bucket = -100000 then 0.0
                        else 2 * pow({_GAMMA!r}::double, bucket) / ({_GAMMA!r}::double + 1) end as x
            from (select {by}metric, any_value(least) as least, bucket, count(*) as n
                  from buckets group by {by}metric, bucket))
          group by {by}metric)"""

    def fences(keys: str) -> str:
        if not floors:
            return whole_fences(keys)
        by = f"{keys}, " if keys else ""
        return f"""
        select {by}max(n_rows) as n_rows, metric,
               max(q1) - 3 * greatest(max(q3) - max(q1), max(least)) as low,
               max(q3) + 3 * greatest(max(q3) - max(q1), max(least)) as high
        from (
          select {by}metric, any_value(least) as least, max(n_rows) as n_rows,
                 min(case when upto >= 0.25 * n_rows then x end) as q1,
                 min(case when upto >= 0.75 * n_rows then x end) as q3
          from (
            select {by}metric, least, sum(n) over (partition by {by}metric order by bucket) as upto,
                   sum(n) over (partition by {by}metric) as n_rows,
                   case when bucket = -100000 then 0.0
                        else 2 * pow({_GAMMA!r}::double, bucket) / ({_GAMMA!r}::double + 1) end as x
            from (select {by}metric, any_value(least) as least, bucket, count(*) as n
                  from buckets group by {by}metric, bucket))
          group by {by}metric)
        group by {by}metric"""

    checks = []
    for m, (a, b, _, low_too) in _RATIOS.items():
        value = f"(case when {b} > 0 then {a} / {b} else 0.0 end)"
        checks.append(f"(f.metric = '{m}' and {value} <= f.high"
                      + (f" and {value} >= f.low)" if low_too else ")"))
    return f"""
    with texts as (select doc_id, lang, source, coalesce(text, '') as text, {_WORDS} as w
                   from documents),
    runs as (select doc_id, i, count(*) over (partition by doc_id, w[i:i + 7]) as n
             from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from texts)),
    covered as (select doc_id, count(distinct i + k) as n_repeat_words
                from runs, range(0, 8) as r(k) where n > 1 group by doc_id),
    lines as (select doc_id, list_filter(string_split(text, chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from texts),
    counts as (
      select t.doc_id, lang, source, len(w) as n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
             len(l) - len(list_distinct(l)) as n_dup_lines,
             coalesce(n_repeat_words, 0) as n_repeat_words, len(l) as n_lines,
             len(w) < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * len(w) as base_failed
      from texts t join lines using (doc_id) left join covered using (doc_id)),
    metric_values as ({values}),
    buckets as (select *, case when x <= 1e-4 then -100000
                               else ceil(ln(x) / ln({_GAMMA!r}::double)) end::bigint as bucket
                from metric_values),
    by_source as ({fences("lang, source")}),
    by_lang as ({fences("lang")}),
    overall as ({fences("")}),
    limits as (
      select s.lang, s.source, s.metric,
             case when s.n_rows >= 100 then s.low when l.n_rows >= 100 then l.low else a.low end as low,
             case when s.n_rows >= 100 then s.high when l.n_rows >= 100 then l.high else a.high end as high
      from by_source s
      join by_lang l on s.lang is not distinct from l.lang and s.metric = l.metric
      join overall a on a.metric = s.metric),
    inside as (
      select c.doc_id, count(*) = {len(_RATIOS)} as ok
      from counts c join limits f
        on c.lang is not distinct from f.lang and c.source is not distinct from f.source
      where {" or ".join(checks)} group by c.doc_id)
    select c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and coalesce(ok, false) as kept
    from counts c left join inside using (doc_id)"""


_MIX = rf"""
with sized as (
  select doc_id, source, len({_WORDS})::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as hash
  from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, ([5.0, 2.0, 1.0]::double[])[(row_number() over (order by source nulls last) - 1) % 3 + 1]
            as weight
  from totals),
levels as (
  select *, (1.5::double * sum(source_size) over ()
             - coalesce(sum(2.0::double * source_size) over (
                 order by 2.0::double * source_size / weight, source nulls last
                 rows between unbounded preceding and 1 preceding), 0.0))
            / sum(weight) over (order by 2.0::double * source_size / weight, source nulls last
                                rows between current row and unbounded following) as level
  from weighted),
targets as (
  select source, source_size,
         least(2.0::double * source_size, weight * max(level) over ()) as target
  from levels),
shares as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole
  from targets),
placed as (
  select d.doc_id, d.size, d.hash, t.*, target - whole * t.source_size as extra,
         sum(d.size) over (partition by d.source order by hash) as upto,
         sum(d.size) over (partition by d.source, hash) as unit
  from sized d join shares t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (size * case when source_size > 0 then whole + (
          upto <= extra or (upto - unit <= extra and 2 * (extra - upto + unit) > unit))::int
        else 0 end)::bigint as taken
from placed"""

_TOP = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as vec
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
queries as (
  select vec_id, min(vec) as vec from vectors where vec_id % 50 = 0 group by vec_id),
ranked as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.vec, c.vec)::bigint as score,
         row_number() over (partition by q.vec_id
                            order by list_inner_product(q.vec, c.vec) desc, c.vec_id) as rank
  from queries q join vectors c on c.vec_id <> q.vec_id)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5"""

_SCORES = rf"""
with texts as (select row_number() over () as d, doc_id, {_WORDS} as w from documents),
words as (select d, unnest(w) as b, generate_subscripts(w, 1) as i from texts),
pairs as (select d, i, b, lag(b) over (partition by d order by i) as a from words),
own1 as (select d, b, count(*) as n from pairs group by d, b),
all1 as (select b, sum(n) as n from own1 group by b),
own2 as (select d, a, b, count(*) as n from pairs where a is not null group by d, a, b),
all2 as (select a, b, sum(n) as n from own2 group by a, b),
sizes as (select d, count(*) as n, sum(count(*)) over () as total from words group by d),
joined as (
  select p.d, p.a, a1.n - o1.n as c1, ac.n - oc.n as context, a2.n - o2.n as c2,
         greatest(s.total - s.n, 1) as rest
  from pairs p join sizes s using (d)
  join own1 o1 on o1.d = p.d and o1.b = p.b join all1 a1 on a1.b = p.b
  left join own1 oc on oc.d = p.d and oc.b = p.a left join all1 ac on ac.b = p.a
  left join own2 o2 on o2.d = p.d and o2.a = p.a and o2.b = p.b
  left join all2 a2 on a2.a = p.a and a2.b = p.b),
shares as (
  select d, case when c2 > 0 then c2::double / context::double
                 when a is not null then 0.4::double * (greatest(c1::double, 0.4::double) / rest::double)
                 else greatest(c1::double, 0.4::double) / rest::double end as share
  from joined),
sums as (select d, sum(floor(log10(share) * 1000000 + 0.5)::bigint)::bigint as units
         from shares group by d)
select doc_id, len(w)::bigint as n_words, coalesce(units, 0)::bigint as units,
       coalesce(units, 0) / 1000000::double as log10_score
from texts left join sums using (d)"""

_TRIGRAM_SCORES = rf"""
with texts as (select row_number() over () as d, doc_id, {_WORDS} as w from documents),
words as (select d, unnest(w) as c, generate_subscripts(w, 1) as i from texts),
grams as (select d, i, c, lag(c) over (partition by d order by i) as b,
                 lag(c, 2) over (partition by d order by i) as a from words),
own1 as (select d, c, count(*) as n from grams group by d, c),
all1 as (select c, sum(n) as n from own1 group by c),
own2 as (select d, b, c, count(*) as n from grams where b is not null group by d, b, c),
all2 as (select b, c, sum(n) as n from own2 group by b, c),
own3 as (select d, a, b, c, count(*) as n from grams where a is not null group by d, a, b, c),
all3 as (select a, b, c, sum(n) as n from own3 group by a, b, c),
sizes as (select d, count(*) as n, sum(count(*)) over () as total from words group by d),
joined as (
  select g.d, g.a, g.b, a1.n - o1.n as n1, ax.n - ox.n as context1, a2.n - o2.n as n2,
         ay.n - oy.n as context2, a3.n - o3.n as n3, greatest(s.total - s.n, 1) as rest
  from grams g join sizes s using (d)
  join own1 o1 on o1.d = g.d and o1.c = g.c join all1 a1 on a1.c = g.c
  left join own1 ox on ox.d = g.d and ox.c = g.b left join all1 ax on ax.c = g.b
  left join own2 o2 on o2.d = g.d and o2.b = g.b and o2.c = g.c
  left join all2 a2 on a2.b = g.b and a2.c = g.c
  left join own2 oy on oy.d = g.d and oy.b = g.a and oy.c = g.b
  left join all2 ay on ay.b = g.a and ay.c = g.b
  left join own3 o3 on o3.d = g.d and o3.a = g.a and o3.b = g.b and o3.c = g.c
  left join all3 a3 on a3.a = g.a and a3.b = g.b and a3.c = g.c),
unigrams as (
  select *, greatest(n1::double, 0.4::double) / rest::double as share1 from joined),
bigrams as (
  select *, case when n2 > 0 then n2::double / context1::double
                 when b is not null then 0.4::double * share1 else share1 end as share2
  from unigrams),
trigrams as (
  select d, case when n3 > 0 then n3::double / context2::double
                 when a is not null then 0.4::double * share2 else share2 end as share
  from bigrams),
sums as (select d, sum(floor(log10(share) * 1000000 + 0.5)::bigint)::bigint as units
         from trigrams group by d)
select doc_id, len(w)::bigint as n_words, coalesce(units, 0)::bigint as units,
       coalesce(units, 0) / 1000000::double as log10_score
from texts left join sums using (d)"""



def _with(label: str, cost: int, edit: str) -> str:
    """A label, nine digits of cost and the audit, after one more edit."""
    return (f"(lpad((substr({label}, 1, 9)::bigint + {cost})::varchar, 9, '0')"
            f" || substr({label}, 10) || '{edit}')")


def _inserted(k: str) -> str:
    """The labels l0 to l3 after inserts, as columns {k}0 to {k}3."""
    user = f"least(l2, {_with('least(l0, l1, l3)', 5, 'I')})"
    return (f"l0 as {k}0, l1 as {k}1, {user} as {k}2,"
            f" least(l3, {_with(user, 5, 'I')}) as {k}3")


def _step() -> str:
    def over(label: str, kept: str, made: str) -> str:
        stay = "(case when faulty then 5 else 0 end)"
        ways = [_with(label, 2, "D")]
        for c, old in (w.split(":") for w in kept.split()):
            ways.append(f"case when not gone and initial = '{c}' then {_with(old, f'{stay}', 'K')} end")
        if made:
            ways.append(f"case when not gone then {_with(made, f'{stay} + 1', 'R')} end")
        return f"least({', '.join(ways)})"
    return (f"{over('m0', '', '')} as l0, {over('m1', 's:m0', '')} as l1, "
            f"{over('m2', 'u:m0 u:m1 u:m3', 'least(m0, m1, m3)')} as l2, "
            f"{over('m3', 'a:m2', 'm2')} as l3")


# The state by state recursion over the turns gives the same least (cost, audit) as the search: a
# label is compared as text. Inserts are never cheapest at these costs, so an audit has a letter
# for each turn.
_REPAIR = rf"""
with recursive bits(i, c, k) as (
  select i, i::bigint, 0 from range(256) t(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1
  from bits where k < 8),
crc as (select list(c order by i) as t from bits where k = 8),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
kinds as (
  select *, xor(list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)),
      lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1])), 4294967295) % 20 as kind
  from keyed, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from kinds where kind != 0),
numbered as (
  select *, row_number() over (
    partition by conv_id order by turn nulls first, role, md5(text)) as i from damaged),
judged as (
  select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
         row_number() over (partition by conv_id, role, text order by i) > 1 as again,
         not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as open, left(role, 1) as initial,
         lag(left(role, 1)) over (partition by conv_id order by i) as before
  from numbered),
turns as (
  select *, not blank and again as duplicate, blank or again as gone,
         not blank and not again and open as faulty from judged),
ends as (select conv_id, max(i) as n from turns group by conv_id),
steps(conv_id, i, l0, l1, l2, l3) as (
  select conv_id, 0::bigint, '000000000', null::varchar, null::varchar, null::varchar from ends
  union all
  select conv_id, i, {_step()}
  from (select s.conv_id, t.i, t.gone, t.faulty, t.initial, {_inserted('m')}
        from steps s join turns t on t.conv_id is not distinct from s.conv_id and t.i = s.i + 1)),
best as (
  select conv_id, substr(label, 1, 9)::bigint as cost, substr(label, 10) as audit
  from (select s.conv_id, least(m0, m3) as label
        from (select conv_id, i, {_inserted('m')} from steps) s
        join ends e on e.conv_id is not distinct from s.conv_id and e.n = s.i)),
edited as (
  select t.*, substr(audit, i, 1) as edit
  from turns t join best b on b.conv_id is not distinct from t.conv_id),
left_over as (
  select *, row_number() over (partition by conv_id order by i) as j,
         first_value(edit = 'K' and initial = 's') over (partition by conv_id order by i) as led
  from edited where edit != 'D'),
told as (
  select conv_id, sha256(string_agg(case when edit = 'K' then role
           when (j - led::int) % 2 = 1 then 'user' else 'assistant' end || ':' || text,
         chr(10) order by i)) as digest from left_over group by conv_id),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
         count_if(blank)::bigint as blank, count_if(duplicate)::bigint as duplicate,
         count_if(faulty)::bigint as truncated,
         count_if(before || initial not in ('su', 'ua', 'au'))::bigint as illegal
  from turns group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
       coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
       coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) e
left join counted c on c.conv_id is not distinct from e.conv_id
left join best b on b.conv_id is not distinct from e.conv_id
left join told d on d.conv_id is not distinct from e.conv_id"""

_COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k, w[i:i + k - 1] as g
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
        from words, range(1, 5) t(k) where len(w) >= k)),
counts as (
  select lang, k, g, count(*) as f from grams group by lang, k, g),
sizes as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
frequent as (select * from counts where f >= 30),
candidates as (select * from frequent where k > 1),
cuts as (
  select lang, k, g, f, unnest(range(1, k)) as c from candidates),
scored as (
  select c.lang, c.k, c.g, c.f, c.c, l.f as l, r.f as r,
         2000000::hugeint * c.f // (l.f::hugeint + r.f) as score
  from cuts c
  join frequent l on l.lang = c.lang and l.g = c.g[1:c.c]
  join frequent r on r.lang = c.lang and r.g = c.g[c.c + 1:c.k]),
lowest as (
  select *, row_number() over (partition by lang, g order by score, c) as p from scored),
inside as (
  select lang, g[i:i + size - 1] as g, max(f) as longest
  from (select lang, g, f, size, unnest(range(1, k - size + 2)) as i
        from candidates, range(2, 4) t(size) where size < k)
  group by all),
placed as (
  select s.lang, array_to_string(s.g, ' ') as phrase, s.f as a, l, r, z.n, score,
         row_number() over (partition by s.lang order by score desc, s.f desc,
                            array_to_string(s.g, ' ')) as rank
  from lowest s join sizes z on z.lang = s.lang
  left join inside i on i.lang = s.lang and i.g = s.g
  where p = 1 and (longest is null or 100::hugeint * longest < 80::hugeint * s.f))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n,
       score::bigint as score
from placed where rank <= 2000"""

ORACLE: dict[str, str] = {
    "op1_maxscore": _TOP,
    "op2_lm_scores_trigram": _TRIGRAM_SCORES,
    "op2_lm_scores": _SCORES,
    "op3_quality_fences": _quality(floors=False),
    "op3_quality_rules": _quality(floors=True),
    "op9_mix_sources": _MIX,
    "op12_collocations": _COLLOCATIONS,
    "op13_repair_conversations": _REPAIR,
}
