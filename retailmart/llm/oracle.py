"""The text operators' results as SQL for DuckDB, where SQL can express them over whole tables."""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"

#: Every document's words with their places from 1.
_WORDS = f"""
texts as (select doc_id, coalesce(text, '') as text from documents),
lists as (select doc_id, text, regexp_extract_all(text, {WORD}) as w from texts),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from lists)"""

_CONTAINED = r"""
with texts as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') as w from documents),
items as (select distinct item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') as w from benchmark),
sized as (select item_id, w, least(5, len(w)) as width from items where len(w) > 0),
item_shingles as (
 select distinct item_id, width, list_slice(w, i, i + width - 1) as shingle
 from (select *, unnest(range(1, len(w) - width + 2)) as i from sized)),
sizes as (select item_id, count(*) as n_shingles from item_shingles group by all),
widths as (select distinct width from sized),
doc_shingles as (
 select distinct doc_id, width, list_slice(w, i, i + width - 1) as shingle
 from (select *, unnest(range(1, len(w) - width + 2)) as i from texts, widths where len(w) >= width)),
shared as (
 select doc_id, item_id, count(*) as n_shared
 from doc_shingles join item_shingles using (width, shingle) group by all)
select doc_id, item_id, n_shared, n_shingles, n_shared::double / n_shingles as containment
from shared join sizes using (item_id) where 10 * n_shared >= 8 * n_shingles"""

_PHRASES = f"""
with {_WORDS},
windows as (
 select doc_id, p, md5(array_to_string(list_slice(w, p, p + 19), ' ')) as body
 from (select doc_id, w, unnest(range(1, len(w) - 18)) as p from lists where len(w) >= 20)),
again as (
 select doc_id, p, row_number() over (partition by body order by doc_id, p) > 1 as seen from windows),
covered as (
 select doc_id, word, p, coalesce(p - max(case when seen then p end) over (
  partition by doc_id order by p rows unbounded preceding) < 20, false) as gone
 from words left join again using (doc_id, p)),
counted as (
 select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed,
  string_agg(word, ' ' order by p) filter (where not gone) as kept
 from covered group by doc_id)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
 sha256(coalesce(kept, '')) as kept_sha256
from texts left join counted using (doc_id)"""

_RULES = rf"""
with {_WORDS},
windows as (
 select doc_id, p, lead(p, 2) over own is not null as whole,
  struct_pack(a := word, b := lead(word) over own, c := lead(word, 2) over own) as body
 from words window own as (partition by doc_id order by p)),
found as (
 select doc_id, p, whole and count(*) over (partition by doc_id, body, whole) > 1 as twice from windows),
repeated as (
 select doc_id, count(*) filter (where twice) as n_repeat_words from (
  select doc_id, bool_or(twice) over (
   partition by doc_id order by p rows between 2 preceding and current row) as twice from found)
 group by doc_id),
lines as (
 select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from (
  select doc_id, unnest(string_split(text, chr(10))) as line from texts)
 where regexp_matches(line, {WORD}) group by doc_id),
counts as (
 select doc_id, len(w)::bigint as n_words,
  length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
  coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g')) as n_letters,
  length(regexp_replace(text, '[^0-9]', '', 'g')) as n_digits
 from lists left join lines using (doc_id) left join repeated using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
 not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 100 * n_symbols > 40 * n_words
  or 100 * n_upper > 40 * n_letters or 100 * n_dup_lines > 50 * n_lines
  or 100 * n_digits > 40 * word_chars or word_chars > 25 * n_words) as kept
from counts"""

# Bytes are read as pairs of hex digits; texts are first cut into stretches, as a long one is slow to index.
_BYTES = """
with texts as (
 select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
stretches as (
 select doc_id, n, start, substring(h, 2 * start + 1, 2 * 399) as s
 from (select *, unnest(range(0, n, 200)) as start from texts)),
bytes as (
 select doc_id, start + i as p, substring(s, 2 * i + 1, 2) as b,
  case when start + i + 200 <= n then md5_number(substring(s, 2 * i + 1, 400)) end as body
 from (select *, unnest(range(0, least(200, n - start))) as i from stretches)),
twice as (select body, true as seen from bytes where body is not null group by body having count(*) > 1),
covered as (
 select doc_id, p, b, coalesce(p - max(case when seen then p end) over (
  partition by doc_id order by p rows unbounded preceding) < 200, false) as gone
 from bytes left join twice using (body)),
counted as (
 select doc_id, count(*) filter (where gone) as n_removed,
  count(*) filter (where gone and not before) as n_spans, string_agg(b, '' order by p) filter (where not gone) as kept
 from (select *, coalesce(lag(gone) over (partition by doc_id order by p), false) as before from covered)
 group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
 sha256(unhex(coalesce(kept, ''))) as kept_sha256
from texts left join counted using (doc_id)"""


_COPIES = r"""
with texts as (
 select doc_id, length(coalesce(text, '')) as n_chars,
  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents),
ranked as (
 select *, row_number() over own as place, first_value(doc_id) over own as keep_id
 from texts window own as (partition by body order by n_chars desc, doc_id))
select doc_id, keep_id, count(*) over (partition by body) as group_size, place = 1 as kept, sha256(body) as text_sha256
from ranked"""

_FIM = """
with texts as (
 select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as d from documents),
drawn as (
 select doc_id, t, n, ('0x' || d[1:8])::bigint % (n + 1) as a, ('0x' || d[9:16])::bigint % (n + 1) as b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
   or ('0x' || d[17:24])::bigint % 100 >= 90 then 'plain'
  when ('0x' || d[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form from texts),
cut as (
 select doc_id, t, n, form, least(a, b) as p, greatest(a, b) - least(a, b) as m,
  substring(t, 1, p) as prefix, substring(t, p + 1, m) as middle, substring(t, p + m + 1) as suffix from drawn)
select doc_id, n, form, case when form <> 'plain' then p end as prefix_chars,
 case when form <> 'plain' then m end as middle_chars,
 sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
  else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
 sha256(t) as restored_sha256 from cut"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_benchmark_decontamination": _CONTAINED,
        "op2_suffix_array_dedup": _BYTES,
        "op7_substring_dedup": _PHRASES,
        "op8_quality_rules": _RULES,
        "op12_exact_dedup": _COPIES,
        "op13_fill_in_middle": _FIM,
    }
