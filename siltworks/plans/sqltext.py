"""SQL forms of the text functions, for the queries' DuckDB side. Written from the rules, not from the Column expressions, so the two check each other."""

from __future__ import annotations

from siltworks.functions import normalize as N
from siltworks.functions import text as T
from siltworks.plans.base import TURNS

SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def without_cot(x: str) -> str:
    return strip(rf"regexp_replace(regexp_replace({x}, '(?s)\[unused16\].*?\[unused17\]', '', 'g'), '(?s)<(?:think|thinking)>.*?</(?:think|thinking)>', '', 'g')")


def sanitized(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '(?i)</?(?:{'|'.join(N.TRAINING_TAGS)})(?:\s[^>]*)?>', '', 'g'), '(?is)```(?:COT|REASONING|THINKING)\b.*?```', '', 'g')"


def present(items: list[str]) -> str:
    """A list of the items that are not null."""
    return f"list_filter([{', '.join(items)}], lambda x: x is not null)"


def any_of(text: str, words) -> str:  # noqa: ANN001
    return "(" + " or ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def hits(text: str, words) -> str:  # noqa: ANN001
    return "(" + " + ".join(f"contains({text}, {lit(w)})::int" for w in words) + ")"


def fences(x: str) -> str:
    case = "case lower(t) " + " ".join(f"when {lit(k)} then {lit(v)}" for k, v in T.FENCE_TAGS.items()) + " end"
    return rf"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all({x}, '```([\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_+#.-]*)', 1), lambda t: {case}), lambda v: v is not null)))"


def keyword_groups(x: str) -> str:
    return "list_sort(" + present([f"case when {any_of(f'lower({x})', ws)} then {lit(g)} end" for g, ws in T.KEYWORDS.items()]) + ")"


def blocks(x: str) -> str:
    return f"(len(string_split({x}, '```')) - 1) // 2"


def ngrams(x: str) -> str:
    """Of a text in lower case with single blanks."""
    at = f"list_transform(range(1, greatest(length({x}) - 1, 1), greatest((length({x}) - 2) // 256, 1))[1:256], lambda i: substr({x}, i, 3))"
    return f"case when {x} = '' then []::varchar[] when length({x}) <= 3 then [{x}] else list_distinct(list_filter({at}, lambda g: trim(g) <> '')) end"


def squeezed(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{SPACE}+', ' ', 'g'))"


def jaccard(a: str, b: str) -> str:
    return f"case when len({a}) > 0 and len({b}) > 0 then len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::double end"


_LABEL = "case role when 'human' then '[Human] ' when 'tool' then '[Tool Result] ' when 'gpt' then '[Assistant Step] ' else '[' || upper(role[1:1]) || role[2:] || '] ' end"
#: Slices of conversations: request, what stands between, response, and their turns' roles.
SEGMENTS = f"""{TURNS}, cl as (select row_id, pos, role, n, {sanitized("case when role = 'gpt' then " + without_cot("value") + " else value end")} as v from turns),
  rp as (select row_id, pos as r, row_number() over (partition by row_id order by pos) as turn_index, count(*) over (partition by row_id) as total_turns from turns where role = 'gpt'),
  a0 as (select rp.row_id, r, turn_index, total_turns, max(c.pos) as h from rp left join cl c on c.row_id = rp.row_id and c.role = 'human' and c.pos < rp.r group by all), ak as (select row_id, r, turn_index, total_turns, coalesce(h, greatest(r - 1, 1)) as a from a0),
  seg as (select ak.row_id, turn_index, total_turns, a, r, max(case when c.pos = a then v end) as request, max(case when c.pos = r then v end) as response,
    coalesce(string_agg(rtrim({_LABEL} || v), chr(10) order by c.pos) filter (where c.pos > a and c.pos < r), '') as trajectory, count(*) filter (where c.pos > a and c.pos < r) as n_trajectory,
    count(*) filter (where c.pos > a and c.pos < r and role = 'tool') as n_tools, string_agg(role, ',' order by c.pos) as pattern from ak join cl c on c.row_id = ak.row_id and c.pos between ak.a and ak.r group by all)"""
_WINDOW = "concat_ws(chr(10), nullif(request, ''), nullif(trajectory, ''), nullif(response, ''))"
SIGNATURES = f"""{SEGMENTS}, wi as (select *, {_WINDOW} as w, {squeezed('request')} as sq, {squeezed('response')} as ss, {squeezed(_WINDOW)} as sw from seg where total_turns > 1),
  sg as (select row_id, turn_index, {keyword_groups('request')} as keywords, case when len({fences('response')}) > 0 then {fences('response')} else {fences('w')} end as langs, n_tools as tools, n_trajectory as turns, pattern,
    {blocks('w')} as blocks, regexp_matches(w, '[\\w./-]+\\.[A-Za-z0-9]{{1,8}}|[\\w./-]+/[\\w./-]+') as files, length(trim(request)) as rq, length(trim(response)) as rs, length(trim(w)) as wl, {ngrams('sq')} as g1, {ngrams('ss')} as g2, {ngrams('sw')} as g3 from wi)"""
_PAIR = ("keywords", "langs", "tools", "turns", "pattern", "blocks", "files", "rq", "rs", "wl", "g1", "g2", "g3")
_RULES = (
    ("language_change", 3.0, "len(langs) > 0 and len(p_langs) > 0 and langs <> p_langs"), ("tool_pattern_change", 2.5, "tools <> p_tools"), ("role_pattern_change", 2.0, "pattern <> p_pattern and (turns > 0 or p_turns > 0)"),
    ("code_density_flip", 2.0, "(blocks = 0) <> (p_blocks = 0)"), ("code_density_shift", 1.0, "(blocks = 0) = (p_blocks = 0) and abs(blocks - p_blocks) >= 2"), ("file_scope_change", 2.0, "files <> p_files"),
    ("keyword_shift", 1.5, "len(keywords) > 0 and len(p_keywords) > 0 and keywords <> p_keywords"), ("request_similarity_drop", 1.5, "d1"), ("short_request_shift", 2.0, "not d1 and least(rq, p_rq) >= 12 and j1 < .1"),
    ("response_similarity_drop", 1.5, "d2"), ("short_response_shift", 2.0, "not d2 and least(rs, p_rs) >= 16 and j2 < .08"), ("window_similarity_drop", 1.0, "least(wl, p_wl) >= 48 and least(len(g3), len(p_g3)) >= 12 and j3 < .22"),
)
_HARD = ("language_change", "file_scope_change", "code_density_flip", "keyword_shift", "short_request_shift", "request_similarity_drop", "short_response_shift", "response_similarity_drop")
BOUNDARIES = f"""{SIGNATURES}, pv as (select row_id, turn_index, {', '.join(_PAIR)}, {', '.join(f'lag({c}) over (partition by row_id order by turn_index) as p_{c}' for c in _PAIR)} from sg),
  js as (select *, {jaccard('g1', 'p_g1')} as j1, {jaccard('g2', 'p_g2')} as j2, {jaccard('g3', 'p_g3')} as j3 from pv),
  dr as (select *, coalesce(least(rq, p_rq) >= 24 and least(len(g1), len(p_g1)) >= 8 and j1 < .25, false) as d1, coalesce(least(rs, p_rs) >= 32 and least(len(g2), len(p_g2)) >= 8 and j2 < .2, false) as d2 from js),
  bo as (select row_id, turn_index, case when p_pattern is null then 0.0 else {' + '.join(f'case when {c} then {s} else 0.0 end' for _, s, c in _RULES)} end as score,
    case when p_pattern is null then [] else {present([f"case when {c} then '{k}' end" for k, _, c in _RULES])} end as reasons from dr),
  bd as (select *, score >= 3.0 as boundary, list_has_any(reasons, {list(_HARD)}) as hard from bo)"""
PLAN = f"""{BOUNDARIES}, k0 as (select *, turn_index - 1 as pos, count(*) over (partition by row_id) as n, count(*) filter (where boundary) over (partition by row_id) as nb from bd),
  k1 as (select *, n >= 8 and nb >= 3 and nb / greatest(n - 1, 1)::double > {{ratio}} as dense, sum(boundary::int) over (partition by row_id order by pos) as stretch from k0),
  k2 as (select *, count(*) over (partition by row_id, stretch) as size from k1), k3 as (select *, sum((boundary and size >= 2)::int) over (partition by row_id order by pos) as g from k2),
  k4 as (select *, count(*) filter (where g = 0) over (partition by row_id) as first_size, max(g) over (partition by row_id) as last_g from k3),
  k5 as (select *, case when dense then 0 when first_size < 2 and last_g > 0 then greatest(g - 1, 0) else g end as segment from k4),
  k6 as (select *, min(pos) over (partition by row_id, segment) as lo, max(pos) over (partition by row_id, segment) as hi from k5),
  k7 as (select *, case when not dense and hi - lo + 1 > 6 then lo + (hi - lo + 1) // 2 end as mid from k6),
  pl as (select *, coalesce(pos = lo or pos = hi or pos = mid, false) as anchor, case when pos = hi then 'segment_end' when pos = lo then case when pos > 0 then 'segment_boundary' else 'segment_start' end when pos = mid then 'segment_mid'
    when boundary and not dense then 'segment_boundary' else 'inherit' end as why, least(pos - lo, hi - pos, coalesce(abs(mid - pos), 1000000)) as distance, case when dense then 0.0 else round(greatest(0.0, least(1.0, 1 - nb / greatest(n - 1, 1)::double * .8)), 3) end as confidence from k7)"""
