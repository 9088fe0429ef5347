"""Queries over scored slices and conversations: values, rarity, metrics, filters, lookups, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import conversation as C
from siltworks.operators import filters as FI
from siltworks.operators import lookups as LU
from siltworks.operators import planning as P
from siltworks.operators import stats as S
from siltworks.operators import value as V
from siltworks.operators.rarity import mid_rank
from siltworks.plans.base import SAMPLES, SLICES, q6, r6, samples, slices
from siltworks.plans.registry import query
from siltworks.session import table

_KEY = "case when source_id is null then 'row:' || row_id when source_file is not null and source_file <> '' then concat_ws('::', source_file, source_id) else source_id end"
_W = f"""k as (select *, {_KEY} as ck from slices),
  w0 as (select *, row_number() over (partition by ck order by turn_index, row_id) as pos, count(*) over (partition by ck) as n from k),
  w as (select *, case when n > 1 then 1 + (pos - 1) / (n - 1)::double else 1.0 end as raw_weight, case when n > 1 then 1 + (pos - 1) / (n - 1)::double else 1.0 end * case when coalesce(inherited, false) then .7 else 1.0 end as weight from w0)"""


def keyed(spark: SparkSession, d: str) -> DataFrame:
    """Every slice with its conversation's key; one without a source id is a conversation of its own."""
    key = C.conversation_key(F.lit(None).cast("string"), F.when(F.col("source_id").isNotNull(), F.col("source_file")), F.col("source_id"))
    return slices(spark, d).withColumn("ck", F.coalesce(key, F.concat(F.lit("row:"), F.col("row_id").cast("string"))))


def weighted(spark: SparkSession, d: str) -> DataFrame:
    return C.weights(keyed(spark, d), "ck", ["turn_index", "row_id"])


_CV = f"""g as (select ck, count(*) as turns, sum(value * weight) / sum(case when value is not null then weight end) as wavg, max(value) as mx, list_sort(list(quality) filter (where quality is not null)) as qs, bool_or(agentic) as ag, max(n_flags) as fl,
  sum(coalesce(score_confidence, 1.0) * weight) / sum(weight) as conf from w group by ck having count(*) >= 2 and count(value) > 0),
  g2 as (select *, .7 * wavg + .3 * mx as q_base, case when ag and len(qs) >= 5 then qs[floor(len(qs) * .1)::int + 1] else qs[1] end as floor from g),
  g3 as (select *, case when floor < 3 then .5 when floor < 5 then .8 else 1.0 end * pow(.95, fl) as penalty from g2),
  cv as (select *, greatest(1.0, least(10.0, case when q_base * penalty <= 5.5 then q_base * penalty else 5.5 + greatest(0.0, least(1.0, conf)) * (q_base * penalty - 5.5) end)) as conv_value from g3)"""


def _values(spark: SparkSession, d: str) -> DataFrame:
    return C.conversation_values(weighted(spark, d).withColumnRenamed("score_confidence", "confidence"), "ck")


@query(f"with {SLICES}, {_W}, {_CV} select ck, turns, {q6('q_base')} as q_base, {q6('floor')} as quality_floor, {q6('penalty')} as penalty, {q6('conv_value')} as conv_value from cv")
def conv_weighted_value(spark: SparkSession, d: str) -> DataFrame:
    v = _values(spark, d)
    return v.select("ck", "turns", r6(F.col("q_base")).alias("q_base"), r6(F.col("floor")).alias("quality_floor"), r6(F.col("penalty")).alias("penalty"), r6(F.col("conv_value")).alias("conv_value"))


_CR = """r as (select ck, count(*) as turns, sum(rarity * weight) / sum(case when rarity is not null then weight end) as rarity_mean, coalesce(max(case when not inherited then rarity end), max(rarity)) as rarity_peak, count(distinct case when not inherited then intent end) as signatures,
  least(1.0, .35 + .65 * sum(case when not inherited then raw_weight else 0.0 end) / sum(raw_weight)) as coverage, sum(coalesce(score_confidence, 1.0) * weight) / sum(weight) as conf from w group by ck having count(rarity) > 0),
  r2 as (select *, least(10.0, .75 * rarity_mean + .25 * rarity_peak + .4 * greatest(0.0, least(1.0, (signatures - 1) / greatest(turns - 1, 1)::double))) as raw, least(1.0, .5 * coverage + .5 * greatest(0.0, least(1.0, conf))) as rc from r),
  cr as (select *, greatest(1.0, least(10.0, case when raw <= 5.5 then raw else 5.5 + rc * (raw - 5.5) end)) as conv_rarity from r2)"""


def _rarity(spark: SparkSession, d: str) -> DataFrame:
    w = weighted(spark, d).withColumnRenamed("score_confidence", "confidence").withColumn("signature", F.col("intent"))
    return C.conversation_rarity(w, "ck")


@query(f"with {SLICES}, {_W}, {_CR} select ck, signatures, {q6('rarity_mean')} as rarity_mean, {q6('rarity_peak')} as rarity_peak, {q6('coverage')} as coverage, {q6('conv_rarity')} as conv_rarity from cr")
def conv_rarity(spark: SparkSession, d: str) -> DataFrame:
    return _rarity(spark, d).select("ck", "signatures", *[r6(F.col(c)).alias(c) for c in ("rarity_mean", "rarity_peak", "coverage", "conv_rarity")])


_TM = """v as (select ck, turn_index, row_id, value from k where value is not null),
  l as (select ck, count(*) as n, avg(value) as mean, min(value) as lo, max(value) as hi, stddev_pop(value) as std, list(value order by value) as vs, list(value order by turn_index, row_id, value) as sq from v group by ck),
  m as (select *, (vs[((n + 1) // 2)::int] + vs[(n // 2 + 1)::int]) / 2 as median, list_avg(vs[greatest(n - 4, 1):n]) as top_mean, list_avg(vs[1:3]) as bottom_mean, least(5, greatest(1, n // 4)) as e from l)"""


@query(f"with {SLICES}, {_W}, {_TM} select ck, n as turns, {q6('mean')} as mean, lo, hi, {q6('median')} as median, {q6('std')} as std, {q6('top_mean')} as top_mean, {q6('bottom_mean')} as bottom_mean, {q6('hi - mean')} as peak_minus_mean, {q6('list_avg(sq[n - e + 1:n]) - list_avg(sq[1:e])')} as late_gain from m")
def conv_topk_bottomk(spark: SparkSession, d: str) -> DataFrame:
    m = C.turn_metrics(keyed(spark, d), "ck", "value", ["turn_index", "row_id"])
    return m.select("ck", "turns", "lo", "hi", *[r6(F.col(c)).alias(c) for c in ("mean", "median", "std", "top_mean", "bottom_mean", "peak_minus_mean", "late_gain")])


@query(f"with {SLICES}, {_W}, {_TM}, q as (select ck, avg(case when quality < 4 then 1.0 else 0.0 end) as low from k where quality is not null group by ck) select m.ck, {q6('(.7 * top_mean + .2 * median + .1 * bottom_mean) * case when low <= .15 then 1.0 when low <= .3 then .95 else .9 end')} as signal from m join q using (ck)")
def conv_turn_signal(spark: SparkSession, d: str) -> DataFrame:
    k = keyed(spark, d)
    m = C.turn_metrics(k, "ck", "value", ["turn_index", "row_id"])
    low = k.where("quality is not null").groupBy("ck").agg(F.avg(F.when(F.col("quality") < 4, 1.0).otherwise(0.0)).alias("low"))
    return m.join(low, "ck").select("ck", r6(C.turn_signal(F.col("top_mean"), F.col("median"), F.col("bottom_mean"), F.col("low"))).alias("signal"))


@query(f"with {SLICES}, {_W} select ck, case when count(*) filter (where thinking_mode = 'slow') > 0 and count(*) filter (where thinking_mode = 'fast') > 0 then 'mixed' when count(*) filter (where thinking_mode = 'slow') > 0 then 'all_slow' when count(*) filter (where thinking_mode = 'fast') > 0 then 'all_fast' else 'unknown' end as summary from k group by ck")
def conv_thinking_summary(spark: SparkSession, d: str) -> DataFrame:
    return C.thinking_summary(keyed(spark, d), "ck", "thinking_mode")


@query(f"with {SLICES}, {_W} select ck, arg_max(intent, (turn_index, row_id)) filter (where intent is not null and intent <> '') as intent from k group by ck")
def conv_merge_labels(spark: SparkSession, d: str) -> DataFrame:
    return C.merge_labels(keyed(spark, d), "ck", ["turn_index", "row_id"], ["intent"], [])


_PC = "((rank() over (order by v) - 1) + (count(*) over (partition by v) - 1) / 2.0) / greatest(count(*) over () - 1, 1)"


@query(f"with {SLICES}, {_W}, {_CV}, {_CR}, a as (select ck, {q6('conv_value')} as v, conv_rarity from cv left join cr using (ck)), b as (select *, {_PC} as p from a) select ck, {q6('greatest(1.0, least(10.0, (.49 * (1 + 9 * p) + .2 * v + case when conv_rarity is not null then .31 * conv_rarity else 0.0 end) / (.69 + case when conv_rarity is not null then .31 else 0.0 end)))')} as selection from b")
def conv_selection(spark: SparkSession, d: str) -> DataFrame:
    v = _values(spark, d).select("ck", r6(F.col("conv_value")).alias("v"))
    j = mid_rank(v, "v", [], "p").join(_rarity(spark, d).select("ck", "conv_rarity"), "ck", "left")
    return j.select("ck", r6(V.compose_selection(1 + 9 * F.col("p"), F.col("v"), F.col("conv_rarity"))).alias("selection"))


@query(f"with {SLICES}, t as (select row_id, turn_index / total_turns::double as pos, row_id % 5 >= 2 as tr, (row_id % 11) / 10.0 as td, row_id % 3 = 0 as ev, row_id % 8 = 0 as li, row_id % 4 as sh, row_id % 6 as vh from slices where turn_index is not null and total_turns > 0), s as (select *, case when sh > 0 and pos >= .7 then 'final-summary' when pos <= .18 and not tr and not ev then 'opener' when li or (td >= .6 and not ev) then 'exploration' when vh > 0 and pos >= .5 then 'verification' else 'implementation' end as st from t), m as (select *, case st when 'opener' then .67 when 'exploration' then .87 when 'verification' then 1.05 when 'final-summary' then .985 else 1.0 end::double * case when li then .82 else 1.0 end * case when st = 'final-summary' then case when ev then 1.04 else .89 end else 1.0 end as b from s) select row_id, st as stage, {q6('greatest(.5, least(1.1, b))')} as multiplier from m")
def stage_multiplier(spark: SparkSession, d: str) -> DataFrame:
    s = slices(spark, d).where("turn_index is not null and total_turns > 0")
    r = F.col("row_id")
    st = V.stage(F.col("turn_index") / F.col("total_turns"), r % 5 >= 2, (r % 11) / 10, r % 3 == 0, r % 8 == 0, r % 4, r % 6)
    s = s.withColumn("stage", st)
    return s.select("row_id", "stage", r6(V.stage_multiplier(F.col("stage"), r % 8 == 0, r % 3 == 0, True)).alias("multiplier"))


_DIST = "least((turn_index - 1) % 4, case when turn_index + 4 - (turn_index - 1) % 4 <= total_turns then 4 - (turn_index - 1) % 4 else total_turns end, abs(total_turns - turn_index))"


@query(f"with {SLICES}, r as (select case when source_id is null or source_id = '' or coalesce(total_turns <= 1, true) or coalesce(turn_index <= 0, true) then 'missing_multiturn_metadata' when total_turns < 8 then 'below_min_turns_threshold' when not inherited then 'non_inherited_turn' when {_DIST} = 0 then 'required_anchor_turn' else 'inherited_mid_turn_estimate' end as reason from slices) select reason, count(*) as n from r group by reason")
def selective_decision(spark: SparkSession, d: str) -> DataFrame:
    s = slices(spark, d)
    return s.groupBy(V.selective_reason(F.col("source_id"), F.col("turn_index"), F.col("total_turns"), F.col("inherited")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"with {SLICES} select row_id, {q6('greatest(1.0, least(10.0, 6 - least(.15 * d, 1.0)))')} as complexity, {q6('greatest(1.0, least(10.0, 5 - case when inherited then .8 else 0.0 end - least(.3 * d, 1.2)))')} as quality from (select *, {_DIST} as d from slices where turn_index > 0 and total_turns > 0)")
def estimate_score(spark: SparkSession, d: str) -> DataFrame:
    s = slices(spark, d).where("turn_index > 0 and total_turns > 0").withColumn("dist", V.anchors_distance(F.col("turn_index"), F.col("total_turns")))
    e = V.estimate(F.lit(6.0), F.col("inherited"), F.col("dist"))
    return s.select("row_id", r6(e["complexity"]).alias("complexity"), r6(e["quality"]).alias("quality"))


@query(f"with {SAMPLES} select row_id, {q6('case when quality <= 5.5 then quality else 5.5 + greatest(0.0, least(1.0, coalesce(score_confidence, 1.0))) * (quality - 5.5) end')} as shrunk from samples")
def confidence_shrink(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("row_id", r6(V.shrink(F.col("quality"), F.col("score_confidence"))).alias("shrunk"))


def _filtered(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    return s.select("*", F.col("labels.difficulty").alias("difficulty"), F.col("quality").alias("value_score"), F.col("rarity").alias("selection_score"))


_FI = f"with {SAMPLES} select row_id from samples where not partial"


@query(f"{_FI} and not inherited and quality is not null and quality >= 5 and coalesce(rarity >= 4, false) and coalesce(correctness >= 4, true) and coalesce(thinking_mode = '' or thinking_mode = 'slow', true) and coalesce(labels.difficulty = '' or labels.difficulty in ('intermediate', 'advanced'), true)")
def filter_null_semantics(spark: SparkSession, d: str) -> DataFrame:
    c = FI.FilterConfig(value_min=5, selection_min=4, correctness_min=4, exclude_inherited=True, thinking_mode="slow", difficulty=("intermediate", "advanced"))
    return _filtered(spark, d).where(FI.matches(c)).select("row_id")


@query(f"{_FI} and coalesce(quality >= 5, true)")
def filter_include_unscored(spark: SparkSession, d: str) -> DataFrame:
    return _filtered(spark, d).where(FI.matches(FI.FilterConfig(value_min=5, include_unscored=True))).select("row_id")


@query(f"{_FI} and coalesce(list_contains(labels.\"language\", 'python') or list_contains(labels.task, 'bug-fixing') or labels.intent = 'bug-fixing' or labels.difficulty = 'bug-fixing' or labels.context = 'bug-fixing' or list_contains(labels.\"language\", 'bug-fixing') or list_contains(labels.\"domain\", 'bug-fixing') or list_contains(labels.concept, 'bug-fixing') or list_contains(labels.agentic, 'bug-fixing') or list_contains(labels.\"constraint\", 'bug-fixing'), false) and not coalesce(labels.difficulty = 'beginner', false)")
def filter_include_exclude(spark: SparkSession, d: str) -> DataFrame:
    c = FI.FilterConfig(include_tags=("language:python", "bug-fixing"), exclude_tags=("difficulty:beginner",))
    return _filtered(spark, d).where(FI.matches(c)).select("row_id")


_LU = """m as (select conversation_key as k, min((coalesce(source_file, ''), conv_value, conv_selection)) as m from conversation_scores where conversation_key is not null group by 1),
  u as (select conversation_uid as k, count(*) as c from conversation_scores where conversation_uid is not null group by 1), i as (select conversation_id as k, count(*) as c from conversation_scores where conversation_id is not null group by 1 having count(*) = 1),
  s as (select row_id, concat_ws('::', metadata.source_file, metadata.source_id) as ck, metadata.source_id as sid from conversation_duplicate_source_id)"""


@query(f"with {_LU} select case when m.k is not null then 'key' when u.k is not null then 'uid' when i.k is not null then 'legacy' else 'none' end as found_by, count(*) as n from s left join m on m.k = s.ck left join u on u.k = s.sid left join i on i.k = s.sid group by 1")
def legacy_id_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _looked_up(spark, d).groupBy("found_by").agg(F.count("*").alias("n"))


def _looked_up(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "conversation_duplicate_source_id")
    sid = F.col("metadata.source_id")
    s = t.select("row_id", F.concat_ws("::", "metadata.source_file", sid).alias("conversation_key"), sid.alias("conversation_uid"), sid.alias("source_id"), F.col("metadata.total_turns").alias("total_turns"))
    return LU.conversation_lookup(s, table(spark, d, "conversation_scores"))


@query("""with r as (select conversation_id as k, max(conv_value) as v, max(conv_selection) as s from conversation_scores where conversation_id is not null group by 1)
  select row_id from conversation_duplicate_source_id t left join r on r.k = t.metadata.source_id where not coalesce(t.metadata.total_turns > 1, false) or (coalesce(v >= 5, false) and coalesce(s >= 5, false))""")
def conversation_gate(spark: SparkSession, d: str) -> DataFrame:
    """A conversation's slices pass if its record reaches the thresholds; a missing record rejects, single turns pass."""
    r = table(spark, d, "conversation_scores").where("conversation_id is not null").groupBy(F.col("conversation_id").alias("k")).agg(F.max("conv_value").alias("conv_value"), F.max("conv_selection").alias("conv_selection"))
    t = table(spark, d, "conversation_duplicate_source_id").join(r, F.col("metadata.source_id") == F.col("k"), "left")
    multi = F.coalesce(F.col("metadata.total_turns") > 1, F.lit(False))
    return t.where(~multi | FI.conversation_criteria({"conv_value": 5, "conv_selection": 5})).select("row_id")


@query(f"""with {SLICES}, {_W}, f as (select *, not coalesce(value >= 6, false) and pos > 1 and pos < n as f from w), r as (select *, row_number() over (partition by ck, f order by value nulls first, pos desc) as r from f) select row_id from r where not f or r > floor(n * .5)""")
def turn_prune(spark: SparkSession, d: str) -> DataFrame:
    return FI.prune_turns(keyed(spark, d), "ck", ["turn_index", "row_id"], "value", F.col("value") >= 6).select("row_id")


_P = "(10), (25), (50), (75), (90)"


@query(f"with {SLICES}, o as (select source_file, value, row_number() over (partition by source_file order by value) - 1 as i, count(*) over (partition by source_file) as n from slices where value is not null), p(pct) as (values {_P}) select source_file, pct::bigint as pct, value from o, p where i = least(n * pct // 100, n - 1)")
def percentiles_index(spark: SparkSession, d: str) -> DataFrame:
    return S.order_statistics(slices(spark, d), "value", (10, 25, 50, 75, 90), ["source_file"])


@query(f"with {SLICES}, o as (select value, row_number() over (order by value) - 1 as i, count(*) over () as n from slices where value is not null), p(pct) as (values {_P}) select pct::bigint as pct, value from o, p where i = round_even((n - 1) * pct / 100.0, 0)")
def percentiles_nearest(spark: SparkSession, d: str) -> DataFrame:
    return S.order_statistics(slices(spark, d), "value", (10, 25, 50, 75, 90), nearest=True)


@query(f"with {SLICES} select source_file, greatest(1, least(10, floor(value)))::bigint as bin, count(*) as n from slices where value is not null group by all")
def histogram_bins(spark: SparkSession, d: str) -> DataFrame:
    return S.histogram(slices(spark, d), "value", ["source_file"])


@query(f"with {SLICES} select source_file, count(*) as n, " + ", ".join(f"{q6(f'avg(case when value >= {t} then 1.0 else 0.0 end)')} as keep_{t}" for t in (4, 5, 6, 7)) + " from slices where value is not null group by source_file")
def keep_rates(spark: SparkSession, d: str) -> DataFrame:
    k = S.keep_rates(slices(spark, d), "value", ["source_file"])
    return k.select("source_file", "n", *[r6(F.col(f"keep_{t}")).alias(f"keep_{t}") for t in (4, 5, 6, 7)])


@query(f"with {SLICES}, x as (select value, string_split(coalesce(source_file, ''), '/') as p from slices), e as (select value, p, unnest(range(0, len(p) + 1)) as depth from x) select array_to_string(p[1:depth], '/') as scope, depth::bigint as depth, count(*) as n, count(value) as scored, {q6('avg(value)')} as mean from e group by 1, 2")
def rollup_scopes(spark: SparkSession, d: str) -> DataFrame:
    return S.scope_rollup(slices(spark, d), "source_file", [F.count("*").alias("n"), F.count("value").alias("scored"), r6(F.avg("value")).alias("mean")])


@query(f"with {SLICES} select source_file, n_flags::bigint as flags, count(value) as n, {q6('avg(value)')} as mean from slices group by all")
def flag_impact(spark: SparkSession, d: str) -> DataFrame:
    return slices(spark, d).groupBy("source_file", F.col("n_flags").cast("long").alias("flags")).agg(F.count("value").alias("n"), r6(F.avg("value")).alias("mean"))


@query(f"with {SLICES}, q as (select *, greatest(1, least(10, floor(value)))::bigint as vb, greatest(1, least(10, floor(rarity)))::bigint as rb from slices where value is not null and rarity is not null) select vb as value_bin, rb as rarity_bin, count(*) as n from q group by all")
def selection_value_grid(spark: SparkSession, d: str) -> DataFrame:
    b = lambda c: F.greatest(F.lit(1), F.least(F.lit(10), F.floor(c))).cast("long")
    return slices(spark, d).where("value is not null and rarity is not null").groupBy(b("value").alias("value_bin"), b("rarity").alias("rarity_bin")).agg(F.count("*").alias("n"))


@query("select case when max(total) > 1 and min(total) <= 1 then 'mixed' when max(total) > 1 then 'multi' else 'single' end as kind, f as source_file, count(*) as n from (select metadata.source_file as f, coalesce(metadata.total_turns, 1) as total from conversation_duplicate_source_id) group by f")
def scope_turn_kind(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "conversation_duplicate_source_id").select(F.col("metadata.source_file").alias("source_file"), F.coalesce("metadata.total_turns", F.lit(1)).alias("t"))
    g = t.groupBy("source_file").agg(F.max("t").alias("hi"), F.min("t").alias("lo"), F.count("*").alias("n"))
    return g.select(F.when((F.col("hi") > 1) & (F.col("lo") <= 1), "mixed").when(F.col("hi") > 1, "multi").otherwise("single").alias("kind"), "source_file", "n")


_PLANNED = """(n <= 12 or pos < 8 or pos = n - 1 or pos in (8, 10, 13, 17, 22, 29, 37, 45, 53, 61, 69, 77, 85, 93))"""


@query(f"with {SLICES}, {_W}, p as (select ck, row_id, pos - 1 as pos, n, row_id % 9 = 0 as hard from w)"
       " , q as (select *, sum(hard::int) over (partition by ck order by pos) as stretch from p)"
       f", z as (select *, {_PLANNED} as planned from q)"
       ", s as (select *, case when not planned then coalesce(min(case when planned then pos end) over (partition by ck, stretch order by pos rows between 1 following and unbounded following), max(case when planned then pos end) over (partition by ck, stretch order by pos rows between unbounded preceding and 1 preceding)) end as source_pos from z)"
       " select row_id, pos, source_pos, planned or source_pos is null as labelled from s")
def inheritance_nearest(spark: SparkSession, d: str) -> DataFrame:
    k = keyed(spark, d).withColumn("hard", F.col("row_id") % 9 == 0)
    return P.inheritance(k, "ck", ["turn_index", "row_id"], "hard").select("row_id", "pos", "source_pos", "labelled")


@query(f"with {SAMPLES} select 'intent' as dim, count(*) as n, " + q6("avg((coalesce(a.labels.intent, '') = coalesce(b.labels.intent, ''))::int)") + " as exact from samples a join samples b on b.row_id = a.row_id + 1")
def model_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Label sets of neighbouring rows, as if from two models."""
    s = samples(spark, d).select("row_id", F.col("labels.intent").alias("intent"))
    a = LU.agreement(s, s.withColumn("row_id", F.col("row_id") - 1), "row_id", ["intent"], [])
    return a.select("dim", "n", r6(F.col("exact")).alias("exact"))


@query(f"with {SAMPLES}, j as (select list_distinct(list_filter(coalesce(a.labels.task, []), lambda x: x is not null)) as x, list_distinct(list_filter(coalesce(b.labels.task, []), lambda x: x is not null)) as y from samples a join samples b on b.row_id = a.row_id + 1) select count(*) as n, {q6('avg(case when len(list_distinct(list_concat(x, y))) = 0 then 1.0 else len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::double end)')} as mean_jaccard from j")
def jaccard_mean(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d).select("row_id", F.filter("labels.task", lambda x: x.isNotNull()).alias("task"))
    a = LU.agreement(s, s.withColumn("row_id", F.col("row_id") - 1), "row_id", [], ["task"])
    return a.select("n", r6(F.col("overlap")).alias("mean_jaccard"))


@query(f"with {SLICES} select id, arg_min(struct_pack(i := intent), row_id).i as intent, min(row_id) as row_id from slices where id is not null group by id")
def migration_first_wins(spark: SparkSession, d: str) -> DataFrame:
    s = slices(spark, d).select("id", "intent", "row_id")
    g = LU.first_rows(s.withColumn("o", F.col("row_id")), ["id"], ["o"])
    return g.select("id", "intent", "row_id")



@query(f"with {SLICES} select row_id, id, source_file, coalesce(intent, '') as intent, value from slices")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    return slices(spark, d).select("row_id", "id", "source_file", F.coalesce("intent", F.lit("")).alias("intent"), "value")


@query(f"with {SLICES} select row_id, value from slices where intent = 'make' and value between 3 and 9 and source_file like '%runs%' order by value desc nulls last, row_id limit 50")
def explorer_topk(spark: SparkSession, d: str) -> DataFrame:
    return slices(spark, d).where("intent = 'make' and value between 3 and 9").where(F.contains("source_file", F.lit("runs"))).orderBy(F.desc_nulls_last("value"), "row_id").limit(50).select("row_id", "value")


@query("select count(*) as n, count(conv_value) as valued, " + q6("avg(conv_value)") + " as mean, count(*) filter (where turn_count >= 8) as long_ones, count(*) filter (where conv_selection >= 7) as selected from conversation_scores")
def conversation_overview(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "conversation_scores")
    return t.agg(F.count("*").alias("n"), F.count("conv_value").alias("valued"), r6(F.avg("conv_value")).alias("mean"), F.count_if(F.col("turn_count") >= 8).alias("long_ones"), F.count_if(F.col("conv_selection") >= 7).alias("selected"))


@query(f"with {SLICES}, {_W} select ck, structure from (select ck, {q6('0.25 * (1 + 9 * (.4 * h)) + .2 * (1 + 9 * greatest(0.0, least(1.0, case when l <= .1 then .65 else 0.0 end))) + .2 * (1 + 9 * (.45 + .2)) + .2 * (1 + 9 * greatest(0.0, least(1.0, .45 * least(1.0, f / 10)))) + .15 * (1 + 9 * greatest(0.0, least(1.0, .45 * h + .35 * (1 - l) + .2)))')} as structure from (select ck, avg(case when value >= 7 then 1.0 else 0.0 end) as h, avg(case when value < 4 then 1.0 else 0.0 end) as l, arg_max(value, (turn_index, row_id)) as f from k where value is not null group by ck))")
def structure_score(spark: SparkSession, d: str) -> DataFrame:
    """The structure score of conversations without edits, tests, files and tools."""
    z = F.lit(0.0)
    g = keyed(spark, d).where("value is not null").groupBy("ck").agg(F.avg(F.when(F.col("value") >= 7, 1.0).otherwise(0.0)).alias("h"), F.avg(F.when(F.col("value") < 4, 1.0).otherwise(0.0)).alias("l"), F.max_by("value", F.struct("turn_index", "row_id")).alias("f"))
    return g.select("ck", r6(C.structure_score(F.col("h"), F.col("l"), z, z, z, z, z, z, z, F.col("f"), z)).alias("structure"))



@query(f"with {SLICES} select intent, count(value) as n, {q6('sum(value)')} as total, min(value) as lo, max(value) as hi, {q6('avg(value)')} as mean from slices where value is not null group by intent")
def merge_stats(spark: SparkSession, d: str) -> DataFrame:
    """Summaries of two halves, merged."""
    s = slices(spark, d).where("value is not null")
    parts = [s.where(F.col("row_id") % 2 == k).groupBy("intent").agg(*S.numeric_summary("value")).drop("mean") for k in (0, 1)]
    m = S.merge_summaries(parts, ["intent"])
    return m.select("intent", "n", r6(F.col("total")).alias("total"), "lo", "hi", r6(F.col("mean")).alias("mean"))


@query(f"with {SLICES} select intent, n_flags::bigint as flags, count(*) as n from slices group by all")
def merge_distributions(spark: SparkSession, d: str) -> DataFrame:
    s = slices(spark, d).withColumn("flags", F.col("n_flags").cast("long"))
    return S.merge_counts([s.where(F.col("row_id") % 3 == k).groupBy("intent", "flags").agg(F.count("*").alias("n")) for k in (0, 1, 2)], ["intent", "flags"])


@query(f"with {SLICES}, b as (select greatest(1, least(10, floor(value)))::bigint as bin, count(*) as n from slices where value is not null group by 1), r as (select *, sum(n) over (order by bin) as hi, sum(n) over () as t from b), p(pct) as (values (25), (50), (75)) select pct::bigint as pct, {q6('bin + (t * pct / 100.0 - (hi - n)) / n')} as value from r, p where t * pct / 100.0 <= hi and t * pct / 100.0 > hi - n")
def percentiles_from_bins(spark: SparkSession, d: str) -> DataFrame:
    p = S.percentiles_from_bins(S.histogram(slices(spark, d), "value"), (25, 50, 75))
    return p.select("pct", r6(F.col("value")).alias("value"))


@query(f"with {SAMPLES} select a.row_id as row_id, coalesce(a.labels.intent, '') as was, coalesce(b.labels.intent, '') as now from samples a join samples b on b.row_id = a.row_id + 1 where coalesce(a.labels.intent, '') <> coalesce(b.labels.intent, '')")
def model_disagreements(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d).select("row_id", F.col("labels.intent").alias("intent"))
    x = LU.disagreements(s, s.withColumn("row_id", F.col("row_id") - 1), "row_id", "intent")
    return x.select("row_id", F.coalesce("left", F.lit("")).alias("was"), F.coalesce("right", F.lit("")).alias("now"))


@query(f"with {SLICES}, {_W}, {_CV}, {_CR} select ck, {q6('greatest(conv_value - .5, least(conv_value + 1.5, greatest(conv_value, case when c <= 5.5 then c else 5.5 + greatest(0.0, least(1.0, conf)) * (c - 5.5) end)))')} as conv_value_v2 from (select cv.ck, cv.conv_value, cv.conf, .8 * cv.mx + .2 * coalesce(cr.conv_rarity, 5.0) as c from cv left join cr using (ck))")
def conv_value_v2(spark: SparkSession, d: str) -> DataFrame:
    """The guarded second value: the better of the first and a shrunk mix of peak and rarity, within -0.5 and +1.5."""
    v = _values(spark, d).join(_rarity(spark, d).select("ck", "conv_rarity"), "ck", "left")
    peak = keyed(spark, d).groupBy("ck").agg(F.max("value").alias("mx"))
    c = 0.8 * F.col("mx") + 0.2 * F.coalesce("conv_rarity", F.lit(5.0))
    return v.join(peak, "ck").select("ck", r6(C.guardrail(F.greatest("conv_value", V.shrink(c, F.col("confidence"))), F.col("conv_value"), 1.5)).alias("conv_value_v2"))
