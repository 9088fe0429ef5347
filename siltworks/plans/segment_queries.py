"""Queries over the slices of conversations: their parts, boundaries, segments, label plans and budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import budgets as B
from siltworks.functions import normalize as N
from siltworks.functions import text as T
from siltworks.operators import planning as P
from siltworks.operators import scorers as SC
from siltworks.operators import slicing as SL
from siltworks.operators import value as V
from siltworks.plans import sqltext as Q
from siltworks.plans.base import q6, r6, turns
from siltworks.plans.registry import query


def parts(spark: SparkSession, d: str) -> DataFrame:
    """``(row_id, turn_index, total_turns, part)``: each slice's own turns."""
    t = turns(spark, d).select("row_id", SL.current_turns(F.col("turns")).alias("s"))
    return t.select("row_id", F.size("s").alias("total_turns"), F.posexplode("s").alias("i", "part")).select("row_id", (F.col("i") + 1).cast("long").alias("turn_index"), F.col("total_turns").cast("long").alias("total_turns"), "part")


@query(f"with {Q.SEGMENTS} select row_id, turn_index::bigint as turn_index, request, trajectory, response, n_trajectory::bigint as n_trajectory, n_tools::bigint as n_tools, pattern from seg")
def scoring_segments(spark: SparkSession, d: str) -> DataFrame:
    s = parts(spark, d).select("row_id", "turn_index", T.segments(F.col("part")).alias("s"))
    return s.select("row_id", "turn_index", "s.request", "s.trajectory", "s.response", F.col("s.n_trajectory").cast("long").alias("n_trajectory"), F.col("s.n_tools").cast("long").alias("n_tools"), "s.pattern")


def _features() -> str:
    """SQL of the stage features of a slice, in two steps."""
    both, cause, fix, ver = "concat_ws(chr(10), request, trajectory, response)", Q.hits("lower(response)", SC.ROOT_CAUSE), Q.hits("lower(response)", SC.FIX), Q.hits("lower(response)", SC.VERIFICATION)
    path, symbol, call = (x.replace("'", "''") for x in (SC.FILE_PATH, SC.SYMBOL, SC.TOOL_CALL))
    one = f"""f1 as (select *, regexp_matches(response, '{path}') as files, regexp_matches(response, '{symbol}') as symbols, {cause} > 0 as cause, {fix} > 0 as fix, {ver} > 0 as ver, {Q.hits('lower(response)', SC.SUMMARY)} as summary_hits,
      {Q.hits(f'lower({both})', SC.VERIFICATION)} as verification_hits, regexp_matches(response, '{call}') or regexp_matches(trajectory, '{call}') as tool_like, regexp_matches(response || chr(10) || trajectory, '{SC.LOW_INFO}') as action,
      len(regexp_extract_all(response, '[A-Za-z_]{{2,}}')) < 80 as few, starts_with(ltrim(response), '{{') or starts_with(ltrim(response), '<tool_call>') as bare, case when n_trajectory > 0 then n_tools / n_trajectory::double else 0.0 end as density from seg)"""
    two = """f2 as (select *, files::int + symbols::int + cause::int + fix::int + ver::int as kinds, (files::int + symbols::int + cause::int + fix::int + ver::int >= 2) or (files and (fix or ver)) as evidence from f1),
      f3 as (select *, few and action and ((tool_like and bare) or (tool_like and not evidence)) as low_info, turn_index / total_turns::double as position from f2),
      f4 as (select *, case when summary_hits > 0 and position >= .7 then 'final-summary' when position <= .18 and trajectory = '' and not evidence then 'opener' when low_info or (density >= .6 and not evidence) then 'exploration'
        when verification_hits > 0 and position >= .5 then 'verification' else 'implementation' end as stage from f3)"""
    return f"{one}, {two}"


def _staged(spark: SparkSession, d: str) -> DataFrame:
    f = parts(spark, d).withColumn("f", SC.stage_features(F.col("part"))).withColumn("position", F.col("turn_index") / F.col("total_turns"))
    st = V.stage(F.col("position"), F.col("f.has_trajectory"), F.col("f.tool_density"), F.col("f.evidence"), F.col("f.low_info"), F.col("f.summary_hits"), F.col("f.verification_hits"))
    return f.select("row_id", "turn_index", st.alias("stage"), "f.*")


@query(f"with {Q.SEGMENTS}, {_features()} select row_id, turn_index::bigint as turn_index, stage, evidence, low_info, kinds::bigint as evidence_kinds, summary_hits::bigint as summary_hits, {q6('density')} as tool_density from f4")
def stage_features(spark: SparkSession, d: str) -> DataFrame:
    s = _staged(spark, d)
    return s.select("row_id", "turn_index", "stage", "evidence", "low_info", F.col("evidence_kinds").cast("long").alias("evidence_kinds"), F.col("summary_hits").cast("long").alias("summary_hits"), r6(F.col("tool_density")).alias("tool_density"))


_MULT = "case stage when 'opener' then {o} when 'exploration' then {e} when 'verification' then {v} when 'final-summary' then {f} else 1.0 end::double * case when low_info then .82 else 1.0 end * case when stage = 'final-summary' then case when evidence then {b} else .89 end else 1.0 end"
_SELECT, _VALUE = _MULT.format(o=0.67, e=0.87, v=1.05, f=0.985, b=1.04), _MULT.format(o=0.68, e=0.90, v=1.03, f=1.0, b=1.0)


@query(f"with {Q.SEGMENTS}, {_features()}, b as (select *, case when row_id % 13 = 0 then null else cast(1 + row_id * 7 % 10 as double) end as value from f4) select row_id, turn_index::bigint as turn_index, {q6(f'case when value is not null then greatest(1.0, least(10.0, value * greatest(.5, least(1.1, {_VALUE})))) end')} as stable, {q6(f'greatest(.5, least(1.1, {_SELECT}))')} as selection_multiplier from b")
def value_stability(spark: SparkSession, d: str) -> DataFrame:
    """Value scores by the stage that the slice's own text shows."""
    s = _staged(spark, d).withColumn("value", F.expr("case when row_id % 13 = 0 then null else cast(1 + row_id * 7 % 10 as double) end"))
    m = lambda sel: V.stage_multiplier(F.col("stage"), F.col("low_info"), F.col("evidence"), sel)
    return s.select("row_id", "turn_index", r6(V.stable_value(F.col("value"), m(False))).alias("stable"), r6(m(True)).alias("selection_multiplier"))


def _domains() -> str:
    out = []
    for k, words in SC.DOMAIN_HINTS.items():
        n = " + ".join(f"contains(t, {Q.lit(w)})::int * {2 if len(w) > 6 else 1}" for w in words)
        if k == "api-development":
            n = f"case when contains(t, 'api') then case when {Q.any_of('t', SC.API_CONTEXT)} then {n} + 1 else greatest({n} - 1, 0) end else {n} end"
        if k == "cloud-computing":
            n = f"{n} + case when {Q.any_of('t', SC.CLOUD_SERVICES)} then 2 else 0 end"
        out.append(f"select row_id, '{k}' as domain, ({n})::bigint as score from x")
    return " union all ".join(out)


@query(f"with {Q.SEGMENTS}, x as (select row_id, lower(concat_ws(chr(10), request, trajectory, response)) as t from seg where turn_index = total_turns), y as ({_domains()}), z as (select *, max(score) over (partition by row_id) as top from y) select row_id, min(domain) as domain from z where score = top and top >= 3 group by row_id having count(*) = 1")
def domain_backfill(spark: SparkSession, d: str) -> DataFrame:
    t = parts(spark, d).where("turn_index = total_turns")
    b = t.select("row_id", SC.domain_backfill(F.col("part"), F.array().cast("array<string>")).alias("domain"))
    return b.where(F.size("domain") > 0).select("row_id", F.element_at("domain", 1).alias("domain"))


@query(f"with {Q.BOUNDARIES} select row_id, turn_index::bigint as turn_index, {q6('score')} as score, array_to_string(reasons, ',') as reasons, boundary, hard from bd")
def segment_boundaries(spark: SparkSession, d: str) -> DataFrame:
    b = turns(spark, d).select("row_id", P.boundaries(SL.current_turns(F.col("turns"))).alias("b")).where(F.size("b") > 1)
    b = b.select("row_id", F.posexplode("b").alias("i", "b"))
    return b.select("row_id", (F.col("i") + 1).cast("long").alias("turn_index"), r6(F.col("b.score")).alias("score"), F.array_join("b.reasons", ",").alias("reasons"), "b.boundary", "b.hard")


def _planned(spark: SparkSession, d: str, ratio: float) -> DataFrame:
    return P.planner(turns(spark, d).select("row_id", SL.current_turns(F.col("turns")).alias("slices")), ["row_id"], fallback_ratio=ratio)


_PL = f"with {Q.PLAN} select row_id, pos::bigint as pos, segment::bigint as segment, lo::bigint as seg_start, hi::bigint as seg_end, anchor, why, case when why = 'segment_boundary' then 'boundary' when why = 'inherit' then 'inherit' else 'required' end as priority, distance::bigint as distance, {q6('confidence')} as confidence, dense as fallback from pl"


def _plan_columns(p: DataFrame) -> DataFrame:
    return p.select("row_id", "pos", *[F.col(c).cast("long").alias(c) for c in ("segment", "seg_start", "seg_end", "distance")], "anchor", "why", "priority", r6(F.col("confidence")).alias("confidence"), "fallback")


@query(_PL.replace("{ratio}", "1.0"))
def planner_anchors(spark: SparkSession, d: str) -> DataFrame:
    return _plan_columns(_planned(spark, d, 1.0))


@query(_PL.replace("{ratio}", "0.4"))
def planner_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Conversations with boundaries at more than two fifths of their steps are one segment."""
    return _plan_columns(_planned(spark, d, 0.4))


_LADDER = "(n <= 3 or pos < 2 or pos = n - 1 or pos in (2, 4, 7, 11, 16, 23, 31, 39, 47, 55, 63))"
_NEAREST = """case when not {p} then coalesce(min(case when {p} then pos end) over (partition by row_id, {by} order by pos rows between 1 following and unbounded following),
  max(case when {p} then pos end) over (partition by row_id, {by} order by pos rows between unbounded preceding and 1 preceding)) end"""


@query(f"with {Q.PLAN.replace('{ratio}', '0.4')}, h as (select *, sum(hard::int) over (partition by row_id order by pos) as st, {_LADDER} as planned from pl), i as (select *, {_NEAREST.format(p='planned', by='st')} as s1, {_NEAREST.format(p='anchor', by='segment, st')} as s2 from h), "
       "j as (select *, planned or s1 is null as l1, anchor or s2 is null as l2 from i), u as (select *, n > 3 and not dense and count(*) filter (where l2) over (partition by row_id) < count(*) filter (where l1) over (partition by row_id) as a from j) "
       "select row_id, pos::bigint as pos, case when a then l2 else l1 end as labelled, (case when a then s2 else s1 end)::bigint as source_pos, case when a then 'anchors' else 'schedule' end as policy from u")
def label_plan(spark: SparkSession, d: str) -> DataFrame:
    """Which slices are labelled and from which the others inherit, with a short schedule."""
    p = P.label_plan(_planned(spark, d, 0.4).withColumnRenamed("pos", "at"), "row_id", ["at"], full_label_count=2, threshold=3, min_gap=2)
    return p.select("row_id", "pos", "labelled", "source_pos", "policy")


@query(f"with {Q.TURNS}, r as (select row_id, count(*) as n from turns where role = 'gpt' group by row_id having count(*) > 1), s as (select row_id, unnest(range(0, n)) as pos, n from r), q as (select *, {_LADDER.replace('n <= 3', 'n <= 2')} as planned from s), "
       f"z as (select *, {_NEAREST.format(p='planned', by='0')} as source_pos from q) select row_id, pos::bigint as pos, source_pos::bigint as source_pos, 'i' || coalesce(source_pos, pos) as intent, source_pos is not null as inherited from z")
def inherited_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of planned slices passed on to the others."""
    from siltworks.operators.inline import inherit

    s = P.inheritance(parts(spark, d).where("total_turns > 1").select("row_id", "turn_index"), "row_id", ["turn_index"], full_label_count=2, threshold=2, min_gap=2)
    s = s.withColumn("intent", F.when(F.col("labelled"), F.concat(F.lit("i"), F.col("pos").cast("string"))))
    return inherit(s.select("row_id", "pos", "source_pos", "intent"), "row_id", "pos", "source_pos", ["intent"]).select("row_id", "pos", "source_pos", "intent", "inherited")


@query()
def labeling_budget(spark: SparkSession, d: str) -> DataFrame:
    """Conversations within 3000 characters for a labeler."""
    b = B.within_budget(turns(spark, d), "row_id", budget=3000)
    return b.select("row_id", "truncated", F.size("turns").alias("n_turns"), B.chars(F.col("turns")).alias("chars"))


@query()
def scoring_budget(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation's last slice within 4000 characters for a scorer."""
    t = turns(spark, d)
    cot = N.cot_text(T.last_text(F.col("turns"), "gpt"))
    return t.select("row_id", B.within_scoring(F.col("turns"), N.thinking_mode(F.col("turns")), cot, 4000).alias("s")).select("row_id", "s.*")
