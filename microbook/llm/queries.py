"""Queries of the training-data operators over whole tables, with production parameters, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from microbook.llm import (
    bpe, exact, html_text, infill, lines, manifest, minhash, mixing, neighbours, quality, rules, secret_scan, token_counts)
from microbook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(table(spark, sf, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.judged(table(spark, sf, "documents"))


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.groups(table(spark, sf, "documents"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.digests(table(spark, sf, "documents"))


def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf, "documents"))


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.order(table(spark, sf, "documents"))


def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extracted(table(spark, sf, "pages"))


def op9_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.grouped(table(spark, sf, "documents"), 85)


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path(WORD_BPE))


def op11_infill(spark: SparkSession, sf: str) -> DataFrame:
    return infill.digests(table(spark, sf, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.grouped(table(spark, sf, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.audit(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_bpe, op2_quality_classifier, op3_quality_rules, op4_exact_dedup, op5_line_dedup, op6_secret_scan, op7_mixing,
    op8_html_extraction, op9_minhash_dedup, op10_token_counts, op11_infill, op12_embedding_dedup, op13_merkle_manifest)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOPS = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)

ORACLES: dict[str, str] = {
    "op3_quality_rules": rf"""
with w as (select doc_id, coalesce(text, '') as text, {_WORDS} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
tri as (select *, list_transform(range(1, len(words) - 1), lambda i: [words[i], words[i + 1], words[i + 2]]) as tris from w),
one as (select row_number() over () as r, * from tri),
place as (select r, unnest(tris) as t, unnest(range(1, len(tris) + 1)) as i from one where len(tris) > 0),
twice as (select r, i from (select r, i, count(*) over (partition by r, t) as n from place) where n > 1),
cover as (select r, count(distinct i + k) as n from twice, (values (0), (1), (2)) as o(k) group by r),
m as (select doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, length(regexp_replace(text, '[^!]', '', 'g')) as n_bangs,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
    len(list_filter(words, lambda x: x in ({_STOPS}))) as n_stops, coalesce(c.n, 0)::bigint as n_repeat_words
  from one left join cover c using (r)),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, greatest(n_words, 1) as u from m),
b as (select *, list_filter([
    case when word_chars / u < 2 or word_chars / u > 20 then 'word_length' end, case when n_symbols / u > 0.2 then 'symbols' end,
    case when n_bangs / u > 0.5 then 'exclamation' end, case when n_stops / u < 0.02 then 'stop_words' end,
    case when n_dup_lines / greatest(n_lines, 1) > 0.5 then 'same_lines' end,
    case when n_lines / u > 0.5 then 'line_length' end], lambda x: x is not null) as broken from j)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and len(broken) = 0 as kept,
  broken from b""",
    "op4_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as text from documents)
select doc_id, min(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size,
  doc_id is not distinct from min(doc_id) over (partition by text) as kept, sha256(text) as text_sha256 from n""",
    "op5_line_dedup": r"""
with one as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select r, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as i from one),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key from k where key <> '' group by key having count(distinct r) >= 10),
m as (select k.*, f.key is not null as bad from k left join f on k.key = f.key),
g as (select r, count(*) as n_lines, count(*) filter (bad) as n_dropped,
    coalesce(string_agg(line, chr(10) order by i) filter (not bad), '') as kept from m group by r)
select one.doc_id, g.n_lines, g.n_dropped, sha256(g.kept) as kept_sha256 from one join g using (r)""",
    "op9_minhash_dedup": r"""
with recursive one as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from one),
g as (select min(doc_id) over (partition by list_sort(s)) as node, doc_id, len(s) as n from s),
nodes as (select doc_id, s, len(s) as n from s where len(s) > 0 and doc_id in (select node from g)),
e as (select doc_id, n, unnest(s) as x from nodes),
c as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as shared from e a join e b on a.x = b.x and a.doc_id < b.doc_id
  where 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by all),
links as (select a, b from c where 100 * shared >= 85 * (na + nb - shared)),
ways as (select a, b from links union select b, a from links),
reach as (select a, b from ways union select reach.a, ways.b from reach join ways on reach.b = ways.a),
comp as (select a as node, least(a, min(b)) as component from reach group by a),
r as (select g.doc_id, g.n::bigint as n_shingles, case when g.n = 0 then g.doc_id else coalesce(comp.component, g.node) end as component_id
  from g left join comp using (node))
select *, doc_id = component_id as kept from r""",
    "op11_infill": r"""
with u as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
    sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
d as (select *, len(units)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from u),
f as (select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
    when h4 % 100 < 20 then 'spm' else 'psm' end as form, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b from d),
c as (select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
    array_to_string(units[b + 1:], '') as suffix from f)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
  sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256 from c""",
    "op12_embedding_dedup": r"""
with recursive v as (select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings),
ok as (select *, sqrt(list_inner_product(e, e)) as size from v where label is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_inner_product(e, e) > 0),
links as (select a.r as a, b.r as b from ok a join ok b on a.label = b.label and len(a.e) = len(b.e) and a.r <> b.r
  where list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.98),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
comp as (select reach.a as r, min(v.vec_id) as least_id from reach join v on v.r = reach.b group by 1),
n as (select a as r, count(*) as n_links from links group by 1),
o as (select v.vec_id, coalesce(n.n_links, 0) as n_links, coalesce(least(v.vec_id, comp.least_id), comp.least_id) as component_id
  from v left join n using (r) left join comp using (r))
select *, vec_id is not distinct from component_id as kept from o""",
    "op13_merkle_manifest": r"""
with recursive f as (select row_number() over () as r, *, case when crc % 3 = 0
    then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as shown from (
  select doc_id, lang, text, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
    xor(list_reduce(list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii((doc_id::varchar)[i])::bigint),
      lambda a, c: list_reduce(range(8), lambda b, k: case when b % 2 = 1 then xor(b // 2, 3988292384) else b // 2 end, xor(a, c)),
      4294967295::bigint), 4294967295) as crc from documents)),
leaves as (select r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) as shown from f),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by lang) as n from leaves),
low(lang, level, pos, n, h) as (select lang, 0, pos, n, leaf from placed union all
  select lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' order by pos)) from low where n > 1 group by lang, level, pos // 8, n),
subs as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from low where n = 1),
high(level, pos, n, h) as (select 0, pos, n, subroot from subs union all
  select level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' order by pos)) from high where n > 1 group by level, pos // 8, n),
top as (select h as root from high where n = 1),
lsib as (select a.lang, a.level, a.pos, a.n, coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as before,
    coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as after
  from low a join low b on a.lang is not distinct from b.lang and a.level = b.level and a.pos // 8 = b.pos // 8 where a.n > 1 group by all),
hsib as (select a.level, a.pos, a.n, coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as before,
    coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as after
  from high a join high b on a.level = b.level and a.pos // 8 = b.pos // 8 where a.n > 1 group by all),
steps as (select p.r, 0 as part, s.level, s.before, s.after from placed p join lsib s
    on s.lang is not distinct from p.lang and s.pos = p.pos // (8 ** s.level)::bigint
  union all select p.r, 1, s.level, s.before, s.after from placed p join subs b on b.lang is not distinct from p.lang
    join hsib s on s.pos = b.pos // (8 ** s.level)::bigint),
ordered as (select *, row_number() over (partition by r order by part, level) as i from steps),
walk as (select r, 0 as i, shown as h from placed union all
  select walk.r, walk.i + 1, sha256(o.before || walk.h || o.after) from walk join ordered o on o.r = walk.r and o.i = walk.i + 1),
folded as (select r, arg_max(h, i) as h from walk group by r),
told as (select r, sha256(string_agg(before || after, '' order by i)) as proof from ordered group by r)
select p.doc_id, p.leaf, b.subroot, top.root, coalesce(told.proof, sha256('')) as proof_sha256, folded.h as folded_root,
  folded.h = top.root as verified
from placed p join subs b on b.lang is not distinct from p.lang join folded using (r) left join told using (r) cross join top""",
}
