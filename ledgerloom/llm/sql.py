"""Plain SQL for the queries that SQL can express: name -> DuckDB SQL over the given tables."""

from __future__ import annotations

from ledgerloom.llm.lines import LEAST_CHARS, LEAST_DOCUMENTS
from ledgerloom.llm.queries import EXTRA_CONVERSATION, EXTRA_TEXT, TOP, URL_RULES

ORACLES: dict[str, str] = {}

_rules = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)
ORACLES["op4_url_filters"] = f"""
with rules(verdict, rule_host, rule_path) as (values {_rules}),
cut as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
named as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw_host,
    substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) as tail from cut),
parsed as (
  select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(tail, '^[^?#]*') as path, row_number() over () as place from named),
fitting as (
  select place, r.verdict, r.rule_host || r.rule_path as rule,
    row_number() over (partition by place order by length(r.rule_host || r.rule_path) desc) as rank
  from parsed join rules r
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parsed left join fitting f on parsed.place = f.place and f.rank = 1
"""

ORACLES["op10_exact_top_k"] = f"""
with usable as (
  select vec_id, embedding from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from usable),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(
    list_resize(q.v, greatest(len(q.v), len(c.v)), 0.0::double),
    list_resize(c.v, greatest(len(q.v), len(c.v)), 0.0::double)) as bigint) as score
  from whole q join whole c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= {TOP}
"""

ORACLES["op1_chat_format"] = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select {EXTRA_CONVERSATION}, 0, 'user', '{EXTRA_TEXT}'
  union all select {EXTRA_CONVERSATION}, 1, 'assistant', '{EXTRA_TEXT}'),
escaped as (
  select *, replace(replace(replace(replace(replace(text, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'),
      '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]') as safe_text,
    replace(replace(replace(replace(replace(role, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'),
      '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]') as safe_role
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(safe_role) + length(safe_text) + {len("<s>[INST]") + len("[/INST]") + len("</s>")}) as bigint)
    as formatted_chars
from escaped group by conv_id
"""

ORACLES["op11_line_dedup"] = f"""
with split as (
  select row_number() over () as place, doc_id, string_split(coalesce(text, ''), chr(10)) as lines
  from documents),
lined as (
  select place, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as nr from split),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lined),
shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= {LEAST_CHARS}
  group by key having count(distinct doc_id) >= {LEAST_DOCUMENTS}),
judged as (
  select k.*, coalesce(k.doc_id <> s.keeper, false) as goes from keyed k left join shared s on k.key = s.key)
select doc_id, count(*) as n_lines, cast(count(*) filter (goes) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by nr) filter (not goes), '')) as kept_sha256
from judged group by place, doc_id
"""
