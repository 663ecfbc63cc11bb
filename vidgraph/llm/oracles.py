"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from vidgraph.llm.chat import END, SEP, STOP, TURN
from vidgraph.llm.licenses import NOTICES, PHRASES, REQUIRED, TEMPLATES, THRESHOLD

# Runs of letters, digits and non-ASCII characters, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return f"regexp_extract_all({LOWERED.format(f'coalesce({text}, chr(32))')}, '{WORD}')"


OP9 = f"""
with d as (select doc_id, {words('text')} w from documents),
items as (select item_id::varchar item, {words('text')} w from benchmark),
wins as (
  select distinct item, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') win, least(len(w), 13) n
  from (select item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) p from items where len(w) > 0)),
lens as (select distinct n from wins),
spots as (
  select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') win
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) p from d, lens where len(w) >= n)),
hits as (select doc_id, p, s.n, item from spots s join wins using (win, n)),
hit_words as (select doc_id, count(distinct q) n_hit
  from (select doc_id, unnest(generate_series(p, p + n - 1)) q from (select distinct doc_id, p, n from hits)) group by 1),
hit_items as (select doc_id, count(distinct item) n_items, string_agg(distinct item, ',' order by item) ids
  from hits group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

OP1 = f"""
with t as (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select doc_id, i, ls[i] line,
    {LOWERED.format("trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} k
  from (select doc_id, ls, unnest(generate_series(1, len(ls))) i from t)),
rep as (select k, max(doc_id) last from l where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
m as (select doc_id, i, line, last is not null and doc_id < last dropped from l left join rep using (k))
select doc_id, count(*) n_lines, count(*) filter (where dropped) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not dropped), '')) kept_sha256
from m group by doc_id
"""

OP2 = """
with sizes as (select source, sum(length(coalesce(text, '')) + 1)::double size from documents group by 1),
rates as (select source, sqrt(size) / (select sum(sqrt(size)) from sizes) * (select sum(size) from sizes) / size rate
  from sizes),
parts as (select source, ceil(rate / 64)::int m, rate / ceil(rate / 64) mean from rates),
cdf as (select source, k, sum(p) over (partition by source order by k) c from (
  select source, k, exp(-mean) * pow(mean, k) / gamma(k + 1) p
  from parts, (select unnest(generate_series(0, 160)) k))),
draws as (select doc_id, text, source, ('0x' || substr(md5('42|' || doc_id || '|' || part), 1, 13))::bigint / 4503599627370496.0 u
  from (select doc_id, text, d.source, unnest(generate_series(1, m)) part
    from documents d join parts p on d.source is not distinct from p.source)),
copies as (select doc_id, any_value(text) as text, source, sum(n)::bigint n_copies from (
  select doc_id, text, source, (select count(*) from cdf where cdf.source is not distinct from draws.source and c <= u) n from draws)
  group by doc_id, source)
select md5('42|order|' || doc_id || '|' || copy) shuffle_key, doc_id, copy, n_copies, source, text
from (select *, unnest(generate_series(1, n_copies)) copy from copies where n_copies > 0)
"""

_BODIES = r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>"


def _escaped(text: str) -> str:
    return f"regexp_replace({text}, '([<\\[])(\\\\*)({_BODIES})', '\\1\\\\\\2\\3', 'g')"


OP4 = f"""
with t as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g as (select conv_id, count(*) n_turns, string_agg(r || chr(10) || x || chr(10), '' order by turn, r, x) turns,
  coalesce(string_agg(x, '' order by turn, r, x) filter (where r = 'assistant'), '') loss,
  sum(length({_escaped('r')}) + length({_escaped('x')}) + {len(TURN + SEP + END)}) + {len(STOP)} formatted_chars
  from t group by conv_id)
select conv_id, n_turns, sha256(turns) turns_sha256, length(loss)::bigint loss_chars, sha256(loss) loss_sha256,
  formatted_chars::bigint formatted_chars
from g
"""


def _values(rows) -> str:
    return ", ".join("('" + "', '".join(r) + "')" for r in rows)


# Blocks are runs of consecutive words of the whole text that start with a template word.
OP10 = f"""
with phrases(phrase, label) as (values {_values(PHRASES.items())}),
required(name, phrase) as (values {_values((n, p) for n, ps in REQUIRED.items() for p in ps)}),
templates as (select name, list_distinct(ws) w, ceil({THRESHOLD} * len(list_distinct(ws)) - 1e-9)::bigint needed,
    ceil(len(ws) / {THRESHOLD} - 1e-9)::bigint longest
  from (select name, {words('t')} ws from (values {_values({**TEMPLATES, **NOTICES}.items())}) v(name, t))),
d as (select doc_id, row_number() over () r, {words('text')} w from documents),
places as (select r, label, p - 1 spot
  from (select r, w, label, string_split(phrase, ' ') f, unnest(generate_series(1, len(w))) p from d, phrases)
  where w[p:p + len(f) - 1] = f),
base as (select r, count(*) n_base, min(spot) first_word, max(spot) last_word,
  string_agg(distinct label, ',' order by label) base_labels, list(distinct label) labels from places group by 1),
likely as (select r, name, d.w, t.w tw, needed, longest from d, templates t
  where len(list_intersect(list_distinct(d.w), t.w)) >= needed),
blocks as (select r, name, tw, needed, w[p:p + longest - 1] b
  from (select *, unnest(generate_series(1, len(w))) p from likely) where list_contains(tw, w[p])),
matches as (select r, name, len(list_intersect(list_distinct(b), tw)) / len(tw) c from blocks
  where len(list_intersect(list_distinct(b), tw)) >= needed and not exists (select 1 from required q
    where q.name = blocks.name and not contains(' ' || array_to_string(b, ' ') || ' ', ' ' || q.phrase || ' '))),
found as (select r, list(distinct name) labels, max(c) best from matches group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word,
  last_word::bigint last_word, coalesce(base_labels, '') base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') labels,
  case when n_base > 0 then 1.0::double else coalesce(best, 0)::double end score
from d left join base using (r) left join found using (r)
"""

# All pairs within a label, and reachability from the smallest ids.
OP5 = """
with recursive v as (select row_number() over () r, vec_id, label, embedding::double[] e from embeddings),
good as (select * from v where label is not null and vec_id is not null and e is not null and len(e) > 0
  and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.r, b.r s from good a join good b on a.label = b.label and len(a.e) = len(b.e) and a.r <> b.r
  where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
reach as (select r, r s from v union select reach.r, links.s from reach join links on links.r = reach.s),
low as (select reach.r, min(v.vec_id) component_id from reach join v on v.r = reach.s group by 1),
n as (select r, count(*) n_links from links group by 1)
select vec_id, coalesce(n_links, 0)::bigint n_links, component_id, vec_id = component_id kept
from v join low using (r) left join n using (r)
"""

# CRC-32 of a text: eight table steps give the 256 table entries, one step per byte the sum.
_CRC_TABLE = f"""
crc_steps as (select i, i::ubigint v, 0 s from (select unnest(generate_series(0, 255)) i)
  union all select i, case when v % 2 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end, s + 1
  from crc_steps where s < 8),
crc_table as (select i, v from crc_steps where s = 8)"""

OP11 = f"""
with recursive {_CRC_TABLE.strip()},
ids as (select distinct conv_id c, conv_id::varchar x from conversations where conv_id is not null),
crc as (select c, x, 1 i, 4294967295::ubigint v from ids
  union all select c, x, crc.i + 1, xor(crc.v >> 8, t.v) from crc
  join crc_table t on t.i = xor(crc.v & 255::ubigint, ascii(x[crc.i])::ubigint) where crc.i <= length(x)),
convs as (select c, c - c % 100 seed, (xor(v, 4294967295::ubigint) % 6)::int h from crc where i = length(x) + 1),
own as (select conv_id c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
  order by turn nulls first, role, text) ts from conversations where conv_id is not null group by 1),
built as (select convs.c, list_concat(coalesce(s.ts, [])[1:h], o.ts[h + 1:]) ts
  from convs join own o using (c) left join own s on s.c = convs.seed),
keyed as (select c, ts, list_transform(ts, lambda t: md5(length(t.r) || ':' || t.r || t.x)) ks from built),
prefixes as (select c, ts, ks, unnest(generate_series(0, len(ts))) d from keyed),
nodes as (select d, array_to_string(ks[1:d], '/') k, min(c) conv_id, count(*) n_convs,
    any_value(array_to_string(ks[1:d - 1], '/')) pk,
    case when d = 0 then 0 else (count(*) - 1) * length(any_value(ts[greatest(d, 1)].x)) end own,
    string_agg(c::varchar, ',' order by c) filter (where d = len(ts)) ends, any_value(ks[1:d]) ks
  from prefixes group by d, k),
kids as (select d - 1 d, pk k, count(*) n from nodes where d > 0 group by all),
full_nodes as (select nodes.*, coalesce(kids.n, 0) n_children from nodes left join kids using (d, k)),
up as (select a, array_to_string(ks[1:a], '/') k, own, n_children
  from (select *, unnest(generate_series(0, d)) a from full_nodes)),
totals as (select a d, k, count(*) filter (where n_children = 0) n_leaves, sum(own) saved from up group by all)
select f.conv_id, f.d depth, p.conv_id parent_conv_id, f.n_convs, f.n_children, t.n_leaves,
  t.saved::bigint saved_tokens, sha256(coalesce(f.ends, '')) ends_sha256
from full_nodes f join totals t using (d, k) left join nodes p on p.d = f.d - 1 and p.k = f.pk
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = f"""
with d as (select doc_id, regexp_extract_all(text, '{TERM}') w, row_number() over () r from documents),
dt as (select r, doc_id, len(w) n, unnest(w) t from d),
tf as (select r, doc_id, n, {LOWERED.format('t')} t, count(*) tf from dt group by all),
total as (select count(*) docs, sum(len(w)) len from d where len(w) > 0),
weight as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint w from tf, total group by t, docs),
q as (select i, item_id, {LOWERED.format('t')} t, count(*) q from (select row_number() over () i, item_id,
  unnest(regexp_extract_all(text, '{TERM}')) t from benchmark) group by all),
scored as (select i, item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len)))) score
  from q join tf using (t) join weight using (t), total group by all),
ranked as (select item_id, row_number() over (partition by i order by score desc, doc_id nulls last) r, doc_id, score
  from scored where score > 0)
select item_id, r::int as rank, doc_id, score::bigint score from ranked where r <= 10
"""

ORACLES = {
    "op1_line_dedup": OP1,
    "op2_mixing": OP2,
    "op4_chat_formatting": OP4,
    "op5_embedding_near_dedup": OP5,
    "op9_benchmark_decontamination": OP9,
    "op10_license_scan": OP10,
    "op11_prefix_trie": OP11,
    "op12_ranked_search": OP12,
}
