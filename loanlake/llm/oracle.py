"""DuckDB SQL of the queries that SQL can express, written from the contracts."""

from __future__ import annotations

from .quality import COMMON_WORDS, MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_REFERENCE, MIN_WORDS

_WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
with recursive w as (
  select doc_id, {_WORDS.format(t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws
  from documents),
shingle as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s
  from w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as u(i) where len(ws) > 0),
size as (select doc_id, count(*) as n from shingle group by doc_id),
link as (
  select a.doc_id as a, b.doc_id as b from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id
  join size x on x.doc_id = a.doc_id join size y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
both_ways as (select a, b from link union all select b, a from link),
reach as (
  select a as doc_id, a as seen from both_ways
  union select r.doc_id, l.b from reach r join both_ways l on l.a = r.seen)
select d.doc_id, coalesce(s.n, 0) as n_shingles,
  coalesce((select min(seen) from reach r where r.doc_id = d.doc_id), d.doc_id) as component_id
from documents d left join size s on s.doc_id = d.doc_id
"""

_CLASSES = [r"\p{Ll}", r"\x20\x09-\x0D", r"\p{Lu}", "0-9", r".,;:!?''\"()\-", "#*$%&|<>"]


def _count(chars: str) -> str:
    return f"length(t) - length(regexp_replace(t, '[{chars}]', '', 'g'))"


def _distance(a: str, n: str, b: str, m: str, size: int) -> str:
    x, y = f"(cast({a}[i] as double) / {n})", f"(cast({b}[i] as double) / {m})"
    term = "case when {0} > 0 then {0} * log2(2 * {0} / ({0} + {1})) else 0 end"
    total = f"list_sum(list_transform(range(1, {size + 1}), lambda i: {term.format(x, y)} + {term.format(y, x)}))"
    return f"round(sqrt(greatest(0, {total} / 2)), 4)"


QUALITY = rf"""
with d as (
  select row_number() over () as rid, doc_id, lang, coalesce(text, '') as t, {_WORDS.format(t="coalesce(text, '')")} as ws
  from documents),
win as (
  select rid, i, count(*) over (partition by rid, ws[i], ws[i + 1], ws[i + 2]) as n
  from d, unnest(range(1, len(ws) - 1)) as u(i)),
hit as (select rid, count(distinct i + k) as n from win, unnest([0, 1, 2]) as v(k) where n > 1 group by rid),
line as (select rid, x from d, unnest(string_split(t, chr(10))) as u(x) where regexp_matches(x, '[^\x20\x09-\x0D]')),
dup as (select rid, count(*) - count(distinct x) as n from line group by rid),
f as (
  select d.rid, doc_id, lang, length(t) as n_all, len(ws) as n_words, {_count(_CLASSES[1])} as n_space,
    {_count(_CLASSES[5])} as n_symbols, coalesce(dup.n, 0) as n_dup_lines, coalesce(hit.n, 0) as n_repeat_words,
    [{", ".join(_count(c) for c in _CLASSES)}] as known,
    [{", ".join(f"len(list_filter(ws, lambda x: lower(x) = '{w}'))" for w in COMMON_WORDS)}] as said
  from d left join dup on dup.rid = d.rid left join hit on hit.rid = d.rid),
g as (
  select *, list_append(known, n_all - list_sum(known)) as classes, list_append(said, n_words - list_sum(said)) as common from f),
ref as (
  select lang, sum(n_all) as ref_all, sum(n_words) as ref_words,
    [{", ".join(f"sum(classes[{k + 1}])" for k in range(len(_CLASSES) + 1))}] as ref_classes,
    [{", ".join(f"sum(common[{k + 1}])" for k in range(len(COMMON_WORDS) + 1))}] as ref_common
  from g group by lang),
s as (
  select g.*, ref_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    case when n_words > 0 then {_distance("classes", "n_all", "ref_classes", "ref_all", len(_CLASSES) + 1)} end as class_distance,
    case when n_words > 0 then {_distance("common", "n_words", "ref_common", "ref_words", len(COMMON_WORDS) + 1)} end as word_distance
  from g join ref on g.lang is not distinct from ref.lang)
select doc_id, n_words, n_all - n_space as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and (n_words < {MIN_WORDS} or n_all - n_space < {MIN_CHARS} or ref_words - n_words < {MIN_REFERENCE}
    or (class_distance <= {MAX_CLASS_DISTANCE} and word_distance <= {MAX_WORD_DISTANCE})) as kept,
  class_distance, word_distance
from s
"""

LINES = r"""
with d as (select row_number() over () as rid, doc_id, text, string_split(text, chr(10)) as lines from documents),
win as (
  select rid, i, row_number() over (partition by lines[i], lines[i + 1], lines[i + 2] order by doc_id nulls last, i) as nth
  from d, unnest(range(1, len(lines) - 1)) as u(i)
  where regexp_matches(concat_ws(' ', lines[i], lines[i + 1], lines[i + 2]), '[^\x20\x09-\x0D]')),
gone as (select rid, list_distinct(list(i + k)) as pos from win, unnest([0, 1, 2]) as v(k) where nth > 1 group by rid)
select doc_id,
  case when gone.rid is null then text else array_to_string(list_transform(
    list_filter(range(1, len(lines) + 1), lambda i: not list_contains(gone.pos, i)), lambda i: lines[i]), chr(10)) end as text,
  coalesce(len(lines), 0) as n_lines, coalesce(len(gone.pos), 0) as n_removed
from d left join gone on gone.rid = d.rid
"""

ORACLE: dict[str, str] = {
    "op1_jaccard_trie_join": JACCARD,
    "op4_divergence_quality": QUALITY,
    "op8_line_windows": LINES,
}
