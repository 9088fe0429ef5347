"""Queries over turns: normalised roles, slices, windows, text features, planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import normalize as N
from siltworks.functions import text as T
from siltworks.operators import slicing as SL
from siltworks.operators.trajectory import structure
from siltworks.plans import sqltext as Q
from siltworks.plans.base import TURNS, q6, r6, turns
from siltworks.plans.registry import query
from siltworks.sources.readers import seeded_sample, stratified_sample
from siltworks.session import table


@query(f"with {TURNS} select role, count(*) as n, count(*) filter (where value = '') as empty from turns group by role")
def role_counts(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select(F.explode("turns").alias("t"))
    return t.groupBy(F.col("t.from").alias("role")).agg(F.count("*").alias("n"), F.count_if(F.col("t.value") == "").alias("empty"))


def _slices(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).withColumn("id", F.concat(F.coalesce("id", F.lit("")), F.lit("#"), F.col("row_id").cast("string")))
    return SL.slices(t)


_SL = """r as (select row_id, pos, row_number() over (partition by row_id order by pos) as ti, count(*) over (partition by row_id) as tt from turns where role = 'gpt'), one as (select row_id, max(n) as n from turns group by row_id),
  sl as (select row_id, ti as turn_index, tt as total_turns, pos as size from r where tt > 1 union all select o.row_id, 1, 1, o.n from one o where o.row_id not in (select row_id from r where tt > 1))"""


@query(f"with {TURNS}, {_SL} select row_id, turn_index::bigint as turn_index, total_turns::bigint as total_turns, size::bigint as size from sl")
def slice_multiturn(spark: SparkSession, d: str) -> DataFrame:
    s = _slices(spark, d)
    return s.select("row_id", F.col("turn_index").cast("long").alias("turn_index"), F.col("total_turns").cast("long").alias("total_turns"), F.size("slice").cast("long").alias("size"))


@query(f"with {TURNS}, {_SL}, c as (select row_id, count(*) as k from sl group by row_id), u as (select row_id, k, sum(k) over (order by row_id) as cum, row_number() over (order by row_id) as rn from c) select row_id, k::bigint as n_slices, cum::bigint as cum_slices from u where cum <= 500 or rn = 1")
def slice_limit_whole_rows(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("row_id", F.greatest(F.size(SL.reply_positions(F.col("turns"))), F.lit(1)).cast("long").alias("n_slices"))
    return SL.whole_rows_limit(t, 500, ["row_id"])


@query(f"with {TURNS} select row_id, arg_max(value, pos) filter (where role = 'human' and value <> '') as last_human, length(arg_max(value, pos) filter (where role = 'gpt' and value <> '')) as reply_chars from turns group by row_id")
def last_turns(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d)
    h, g = T.last_text(F.col("turns"), "human"), T.last_text(F.col("turns"), "gpt")
    return t.select("row_id", F.nullif(h, F.lit("")).alias("last_human"), F.nullif(F.length(g), F.lit(0)).cast("long").alias("reply_chars"))


@query(f"with {TURNS} select row_id, coalesce(arg_min(value, pos) filter (where role = 'human'), '')[1:100] as query from turns group by row_id")
def review_query_text(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).select("row_id", T.first_query(F.col("turns")).alias("query"))


@query(rf"with {TURNS} select row_id, case when bool_or(regexp_matches(value, '<(?:think|thinking)>.*?</(?:think|thinking)>', 's') or regexp_matches(value, '\[unused16\].*?\[unused17\]', 's')) then 'slow' else 'fast' end as mode from turns group by row_id")
def thinking_mode(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).select("row_id", N.thinking_mode(F.col("turns")).alias("mode"))


@query(f"with {TURNS} select row_id from turns group by row_id having count(*) filter (where role = 'gpt') = 1 and count(*) >= 5 and count(*) filter (where role = 'tool') >= 2")
def trajectory_objects(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).where(SL.trajectory_object(F.col("turns"))).select("row_id")


@query(f"with {TURNS} select row_id, sum(len(string_split(value, '```')) - 1)::bigint // 2 as blocks, sum(length(value) // 4)::bigint as tokens from turns group by row_id")
def code_block_count(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d)
    text = F.array_join(F.transform("turns", lambda x: x["value"]), "\n")
    tok = F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + T.tokens_estimate(x["value"]))
    return t.select("row_id", T.code_blocks(text).cast("long").alias("blocks"), tok.alias("tokens"))


@query(f"with {TURNS}, t as (select value, pos, row_id from turns where role = 'human'), k as (select row_id, pos, unnest([{', '.join(f'[{g!r}, {w!r}]' for g, v in T.KEYWORDS.items() for w in v)}]) as k, lower(value) as v from t) select k[1] as grp, k[2] as word, count(*) as n from k where contains(v, k[2]) group by all")
def keyword_groups(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select(F.explode("turns").alias("t")).where("t.from = 'human'")
    e = t.select(F.explode(T.keyword_hits(F.col("t.value"))).alias("grp", "ws")).select("grp", F.explode("ws").alias("word"))
    return e.groupBy("grp", "word").agg(F.count("*").alias("n"))


@query(f"with {TURNS}, t as (select row_id, pos, len(regexp_extract_all(value, '[\\x{{4E00}}-\\x{{9FFF}}]')) as zh, len(regexp_extract_all(value, '[A-Za-z]')) as en from turns) select row_id, pos::bigint as pos, case when zh + en = 0 then 'unknown' when least(zh, en) / (zh + en)::double > .2 then 'mixed' when zh > en then 'zh' else 'en' end as dominant, {q6('case when zh + en > 0 then zh / (zh + en)::double else 0.0 end')} as zh_ratio from t")
def language_mix(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("row_id", F.posexplode("turns").alias("pos", "t"))
    m = T.language_mix(F.col("t.value"))
    return t.select("row_id", (F.col("pos") + 1).cast("long").alias("pos"), m["dominant"].alias("dominant"), r6(m["zh_ratio"]).alias("zh_ratio"))


@query(f"with {TURNS} select row_id, pos::bigint as pos, case when length(value) <= 400 then value else value[1:120] || e'\\n\\n[... content truncated for labeling ...]\\n\\n' || value[-(400 - 120 - {len(T.MARKER)}):] end as value from turns")
def truncate_head_tail(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("row_id", F.posexplode("turns").alias("pos", "t"))
    return t.select("row_id", (F.col("pos") + 1).cast("long").alias("pos"), T.truncate(F.col("t.value"), 400).alias("value"))


@query(f"with {TURNS}, h as (select row_id, pos, {Q.squeezed('value')} as t from turns where role = 'human'), p as (select row_id, pos, t, lag(t) over (partition by row_id order by pos) as u from h), g as (select row_id, pos, {Q.ngrams('t')} as a, {Q.ngrams('u')} as b from p where u is not null) select row_id, pos::bigint as pos, {q6(Q.jaccard('a', 'b'))} as similarity from g")
def char_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of each request to the one before it in its conversation; null where one of them is empty."""
    asked = F.filter(F.transform("turns", lambda t, i: F.struct((i + 1).cast("long").alias("pos"), t["from"].alias("from"), T.char_ngrams(t["value"]).alias("g"))), lambda t: t["from"] == "human")
    t = turns(spark, d).select("row_id", asked.alias("h")).where(F.size("h") > 1)
    pairs = F.zip_with(F.slice("h", 2, F.size("h")), F.slice("h", 1, F.size("h") - 1), lambda a, b: F.struct(a["pos"].alias("pos"), T.jaccard(a["g"], b["g"]).alias("similarity")))
    x = t.select("row_id", F.explode(pairs).alias("p"))
    return x.select("row_id", F.col("p.pos").alias("pos"), r6(F.col("p.similarity")).alias("similarity"))


@query()
def text_signals(spark: SparkSession, d: str) -> DataFrame:
    """All signals of a conversation in one row."""
    t = turns(spark, d)
    text = F.array_join(F.transform("turns", lambda x: x["value"]), "\n")
    return t.select("row_id", T.fence_languages(text).alias("fences"), T.framework_languages(text).alias("frameworks"), T.tool_tags(F.col("turns")).alias("tool_tags"), T.behaviours(F.col("turns")).alias("behaviours"), T.code_blocks(text).alias("blocks"), SL.trajectory_object(F.col("turns")).alias("trajectory"))



@query()
def conversation_uids(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).select("row_id", N.conversation_uid(F.col("id"), F.col("turns"), F.col("source_file"), F.col("row_id")).alias("uid"))



@query()
def turn_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of at most 6 turns every 4, of conversations with more than 6."""
    w = SL.windows(turns(spark, d), longer_than=6, size=6, stride=4)
    return w.select("row_id", "window_index", "total_windows", "turn_start", "turn_end", "prefix_turns", F.size("body").alias("n_body"), r6(T.snr(F.col("body"))).alias("snr"))






@query()
def structure_signals(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).select("row_id", structure(F.col("turns")).alias("s")).select("row_id", "s.*")
