"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from .reputation import SUFFIXES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ALPHABETS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

TWO_LABELS = "array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')"
THREE_LABELS = "array_to_string(list_slice(string_split(host, '.'), -3, -1), '.')"

URL_REPUTATION = f"""
with parsed as (
  select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as rest from pages
), pages_ as (
  select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {ALPHABETS}), '') as host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from parsed
), outcomes as (
  select regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as host, case when quality = 0 or toxic = 1 then 1 when quality is null or toxic is null then null else 0 end as bad
  from pages_ join labels on labels.doc_id = try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1), '') as bigint)
), hosts as (
  select host, count(*) as n, sum(bad)::bigint as k,
         case when {TWO_LABELS} in {SUFFIXES} then {THREE_LABELS} else {TWO_LABELS} end as domain,
         case when {TWO_LABELS} in {SUFFIXES} then {TWO_LABELS} else string_split(host, '.')[-1] end as suffix
  from outcomes where bad is not null group by host
), domains as (select domain, suffix, sum(n)::bigint as n, sum(k)::bigint as k from hosts group by domain, suffix
), suffixes as (select suffix, sum(n)::bigint as n, sum(k)::bigint as k from domains group by suffix
), everything as (select sum(n)::bigint as n, sum(k)::bigint as k from suffixes
), members as (
  select 'host' as level, domain as parent, n, k from hosts union all
  select 'domain', suffix, n, k from domains union all select 'suffix', '', n, k from suffixes
), parts as (
  select level, parent, sum(n)::double as n, sum(k)::double as k, count(*) as members,
         sum((k * k / n)::decimal(28,6))::double as kk, sum((n * n)::decimal(38,0))::double as nn
  from members group by level, parent
), totals as (
  select level, sum((kk - k * k / n - (members - 1) * k * (n - k) / (n * n))::decimal(28,6))::double as between_,
         sum((n - nn / n)::decimal(28,6))::double as size, sum((k * (n - k) / n)::decimal(28,6))::double as inside, sum(n) as n
  from parts group by level
), shares as (
  select level, case when size * inside <> 0 then between_ * n / (size * inside) end as share from totals
), strengths as (
  select level, round(case when share > 0 then greatest(1.0, least(1000.0, 1 / share - 1)) else 1000.0 end, 3)::double as s from shares
), suffix_means as (
  select suffix, (suffixes.k + s * (everything.k::double / everything.n)) / (suffixes.n + s) as mean
  from suffixes, everything, strengths where level = 'suffix'
), domain_means as (
  select domain, (k + s * mean) / (n + s) as mean from domains join suffix_means using (suffix), strengths where level = 'domain'
), host_means as (
  select host, (k + s * mean) / (n + s) as m, n + s as size from hosts join domain_means using (domain), strengths where level = 'host'
), bounds as (select host as site, m - 1.645 * sqrt(m * (1 - m) / (size + 1)) as bound from host_means
), ruled as (
  select page_id, host, path, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from pages_
)
select page_id, host, path, rule, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
       when bound > 0.5 then 'block' else 'allow' end as verdict
from ruled left join bounds on site = regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '')
"""

JACCARD_JOIN = f"""
with recursive words as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingles as (
  select distinct r, case when len(w) < 5 then w else list_slice(w, i, i + 4) end as s
  from (select r, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)
), sizes as (select r, count(*) as n from shingles group by r
), shared as (select a.r as a, b.r as b, count(*) as both_ from shingles a join shingles b on a.s = b.s and a.r < b.r group by all
), links as (
  select a, b from shared join sizes x on x.r = a join sizes y on y.r = b where 100 * both_ >= 80 * (x.n + y.n - both_)
), edges as (select a, b from links union all select b, a from links
), reach as (select r as a, r as b from words union select reach.a, edges.b from reach join edges on edges.a = reach.b
), least_ as (select reach.a as r, min(words.doc_id) as component_id from reach join words on words.r = reach.b group by reach.a)
select doc_id, coalesce(n, 0) as n_shingles, component_id from words left join sizes using (r) join least_ using (r)
"""

REPEATED_PASSAGES = f"""
with words as (select doc_id, row_number() over () as r, {WORDS} as w from documents
), places as (select r, w, unnest(range(1, len(w) + 1)) as i from words
), windows as (select r, i, w[i] as word, case when i + 34 <= len(w) then list_slice(w, i, i + 34) end as s from places
), often as (select s from windows where s is not null group by s having count(*) > 1
), marked as (select r, i, word, (often.s is not null)::int as mark from windows left join often on often.s = windows.s
), gone as (select r, i, word, max(mark) over (partition by r order by i rows between 34 preceding and current row) as gone from marked
), rest as (
  select r, count(*) as n_words, sum(gone)::bigint as n_removed, string_agg(word, ' ' order by i) filter (where gone = 0) as kept
  from gone group by r
)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words left join rest using (r)
"""

TOP_K = """
with rows_ as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, q.r as q, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from rows_ q join rows_ c on q.vec_id % 50 = 0 and q.r <> c.r
), ranked as (select *, row_number() over (partition by q order by score desc, vec_id) as place from scored)
select query_id, place::integer as rank, vec_id, score from ranked where place <= 5
"""

SOURCE_MIX = f"""
with counted as (select doc_id, source, len({WORDS})::bigint as size from documents
), numbered as (select *, row_number() over (partition by doc_id, source, size) - 1 as copy from counted
), sized as (
  select doc_id, source, size, case when size > 0 then greatest(1, floor(16 * sqrt(size::double))) else 0 end::bigint as chance,
         (cast('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || size || ':' || copy), 1, 12) as bigint)::double + 0.5)
           / 281474976710656.0::double as u
  from numbered
), sources as (
  select source, sum(size)::bigint as source_size, [3.0, 1.0, 2.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight
  from sized group by source
), levels as (
  select *, 2.0::double * source_size as cap,
         (1.5::double * sum(source_size) over () - coalesce(sum(2.0::double * source_size) over before_, 0.0::double))
           / (sum(weight) over () - coalesce(sum(weight) over before_, 0.0::double)) as level
  from sources
  window before_ as (order by 2.0::double * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
), targets as (
  select source, source_size, coalesce(least(cap, (select min_by(level, cap / weight) from levels where level * weight <= cap) * weight), 0.0::double) as target
  from levels
), parts as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as copies from targets
), figures as (select *, target - copies * source_size as words_left from parts
), steps as (
  select by_chance.source, chance, (words_left - coalesce(sum(words) over (falling rows between unbounded preceding and 1 preceding), 0))::double as rest,
         (sum(moment) over (falling rows between current row and unbounded following))::double as scale
  from (select source, chance, sum(size) as words, sum(size * chance) as moment from sized group by source, chance) by_chance
  join figures f on f.source is not distinct from by_chance.source and words_left > 0
  window falling as (partition by by_chance.source order by chance desc)
), left_ as (
  select source, max(chance) as sure, max_by(rest, chance) as rest, max_by(scale, chance) as scale from steps where rest * chance < scale group by source
), shared as (
  select doc_id, sized.source, size, chance, u, source_size, target, copies, sure, rest, rest * chance / scale as share
  from sized join figures on sized.source is not distinct from figures.source left join left_ on sized.source is not distinct from left_.source
), ranked as (
  select *, (u / (1 - u)) / nullif(share / (1 - share), 0) as pareto, chance > sure as certain from shared
), placed as (
  select *, coalesce(sum(size) over (partition by source, certain order by coalesce(pareto / (1 + pareto), 1.0), doc_id, size
                                     rows between unbounded preceding and 1 preceding), 0) as before_
  from ranked
)
select doc_id, size, source_size, target,
       (size * (copies + coalesce((certain or 2 * before_ + size <= 2 * rest)::int, 0)))::bigint as taken from placed
"""

COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), {ALPHABETS}), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w
  from documents
), places as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces
), grams as (select lang, list_slice(w, i, i + m - 1) as p from places, range(1, 5) as lengths(m) where i + m - 1 <= len(w)
), counts as (select lang, p, count(*) as f from grams group by lang, p
), totals as (select lang, sum(f)::bigint as n from counts where len(p) = 1 group by lang
), often as (select lang, p, f as a from counts where len(p) > 1 and f >= 30
), cuts as (
  select lang, p, a, unnest(range(1, len(p))) as k from often
), scored as (
  select cuts.*, x.f as l, y.f as r, (2000000 * a::hugeint) // (x.f + y.f) as score
  from cuts join counts x on x.lang = cuts.lang and x.p = list_slice(cuts.p, 1, k)
  join counts y on y.lang = cuts.lang and y.p = list_slice(cuts.p, k + 1, len(cuts.p))
), lowest as (select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1
), inner_ as (
  select lang, list_slice(p, i, i + m - 1) as p, max(a) as longer
  from (select lang, p, a, m, unnest(range(1, len(p) - m + 2)) as i from often, range(2, 4) as lengths(m) where m < len(p))
  group by all
), kept as (
  select lowest.* from lowest left join inner_ using (lang, p) where longer is null or 100 * longer::hugeint < 80 * a::hugeint
), ranked as (
  select *, array_to_string(p, ' ') as phrase,
         row_number() over (partition by lang order by score desc, a desc, encode(array_to_string(p, ' '))) as rank
  from kept
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""

TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

LEXICAL_SEARCH = f"""
with docs as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), {TERM}) as t from documents
), figures as (select count(*)::bigint as nd, sum(len(t))::bigint as nl from docs where len(t) > 0
), postings as (select r, doc_id, len(t)::bigint as n, unnest(t) as term from docs
), counted as (select r, doc_id, n, term, count(*)::bigint as tf from postings group by all
), weights as (
  select term, floor(1000 * ln((2 * nd + 2)::double / (2 * count(*) + 1)::double))::bigint as w from counted, figures group by term, nd
), items as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), {TERM})) as term from benchmark
), scored as (
  select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nl))))::bigint as score
  from items join counted using (term) join weights using (term), figures group by item_id, r, doc_id
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place from scored where score > 0
)
select item_id, place::integer as rank, doc_id, score from ranked where place <= 50
"""
