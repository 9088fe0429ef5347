"""Queries over labels: distributions, combinations, rarity, canonical spelling, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import labels as L
from siltworks.operators import rarity as R
from siltworks.operators import value as V
from siltworks.operators.stats import coverage_at
from siltworks.plans.base import SAMPLES, TAGS, q6, r6, samples
from siltworks.plans.registry import query
from siltworks.session import table

_DIMS = ("language", "domain", "task", "concept", "agentic", "constraint")
W = "case dim when 'intent' then .15 when 'difficulty' then .3 when 'context' then .5 when 'language' then 1.0 when 'domain' then 1.5 when 'task' then 1.0 when 'concept' then 2.0 when 'agentic' then 1.5 else 1.0 end::double"


def _long(spark: SparkSession, d: str) -> DataFrame:
    return L.tags_long(samples(spark, d), ["row_id"])


def _n(spark: SparkSession, d: str) -> int:
    return samples(spark, d).where("labels is not null").count()


@query(f"with {TAGS} select dim, tag, count(*) as n from tags group by all")
def tag_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.distribution(_long(spark, d))


@query(f"with {TAGS}, g as (select dim, tag, count(*) as n, avg(confidence) as mean, min(confidence) as lo, count(*) filter (where confidence < 0.6) as low from tags group by all) select dim, tag, n, {q6('mean')} as mean, {q6('lo')} as lo, low from g")
def tag_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _long(spark, d).groupBy("dim", "tag").agg(F.count("*").alias("n"), r6(F.avg("confidence")).alias("mean"), r6(F.min("confidence")).alias("lo"), F.count_if(F.col("confidence") < 0.6).alias("low"))


@query(f"with {SAMPLES} select coalesce(labels.intent, '') as intent, coalesce(labels.difficulty, '') as difficulty, count(*) as n from samples where labels is not null and not inherited group by all")
def cross_matrix(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d).where("labels is not null and not inherited")
    return s.groupBy(F.coalesce("labels.intent", F.lit("")).alias("intent"), F.coalesce("labels.difficulty", F.lit("")).alias("difficulty")).agg(F.count("*").alias("n"))


@query(f"with {TAGS}, u as (select dim, tag, count(*) as n from tags group by all) select p.dim as dim, count(*) as pool, count(u.n) as used, count(*) - count(u.n) as unused from tag_pool p left join u on u.dim = p.dim and u.tag = p.tag group by all")
def pool_coverage(spark: SparkSession, d: str) -> DataFrame:
    used = R.distribution(_long(spark, d))
    j = table(spark, d, "tag_pool").join(used, ["dim", "tag"], "left")
    return j.groupBy("dim").agg(F.count("*").alias("pool"), F.count("n").alias("used"), (F.count("*") - F.count("n")).alias("unused"))


def _part(d: str, cap: int) -> str:
    return f"""case when len(list_filter(labels."{d}", lambda x: x is not null and x <> '')) > 0 then '{d}=' || array_to_string(list_sort(list_distinct(list_filter(labels."{d}", lambda x: x is not null and x <> '')))[1:{cap}], ',') end"""


_COMBO = "concat_ws('|', " + ", ".join([*(f"case when labels.{d} <> '' then '{d}=' || labels.{d} end" for d in ("intent", "difficulty", "context")), *(_part(d, 3 if d == "concept" else 2) for d in _DIMS)]) + ")"


@query(f"with {SAMPLES}, k as (select nullif({_COMBO}, '') as combo from samples where labels is not null) select combo, count(*) as n from k where combo is not null group by all")
def combo_counts(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d).where("labels is not null").select(L.combo_key(F.col("labels")).alias("combo"))
    return s.where("combo is not null").groupBy("combo").agg(F.count("*").alias("n"))


_IDF = "dist as (select dim, tag, count(*) as n from tags group by all), total as (select count(*) as t from samples where labels is not null), idf0 as (select dim, tag, n, greatest(0.0, log2(t / (n + 1.0))) as idf from dist, total), idf as (select *, avg(idf) over (partition by dim) as prior from idf0)"


@query(f"with {TAGS}, {_IDF} select dim, tag, n, {q6('idf')} as idf, {q6('prior')} as prior from idf")
def tag_idf(spark: SparkSession, d: str) -> DataFrame:
    t = R.idf_table(R.distribution(_long(spark, d)), _n(spark, d))
    return t.select("dim", "tag", "n", r6(F.col("idf")).alias("idf"), r6(F.col("prior")).alias("prior"))


_RAR = f"""per as (select row_id, dim, max(confidence) as c, max(prior) as prior, 0.6 * max(idf) + 0.4 * avg(idf) as obs from tags join idf using (dim, tag) group by row_id, dim),
  rar as (select row_id, sum({W} * (c * obs + (1 - c) * prior)) / sum({W}) as tag_rarity, avg(c) as confidence from per group by row_id)"""


@query(f"with {TAGS}, {_IDF}, {_RAR} select row_id, {q6('tag_rarity')} as tag_rarity, {q6('confidence')} as confidence from rar")
def sample_rarity_raw(spark: SparkSession, d: str) -> DataFrame:
    long = _long(spark, d)
    r = R.sample_rarity(long, R.idf_table(R.distribution(long), _n(spark, d)), "row_id")
    return r.select("row_id", r6(F.col("tag_rarity")).alias("tag_rarity"), r6(F.col("confidence")).alias("confidence"))


_COMB = f"""ck as (select row_id, nullif({_COMBO}, '') as combo from samples where labels is not null), cn as (select combo, count(*) as cnt from ck where combo is not null group by all),
  raw as (select r.row_id, .7 * r.tag_rarity + .3 * case when cnt is null then 0.0 else r.confidence * log2(t / (cnt + 1.0)) + (1 - r.confidence) * r.tag_rarity end as raw, t from rar r join ck using (row_id) left join cn using (combo), total)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    s, long, n = samples(spark, d), _long(spark, d), _n(spark, d)
    r = R.sample_rarity(long, R.idf_table(R.distribution(long), n), "row_id")
    k = s.where("labels is not null").select("row_id", L.combo_key(F.col("labels")).alias("combo"))
    j = r.join(k, "row_id").join(combo_counts(spark, d).withColumnRenamed("n", "cnt"), "combo", "left")
    return j.select("row_id", R.raw_rarity(F.col("tag_rarity"), R.combo_rarity(F.col("cnt"), n, F.col("confidence"), F.col("tag_rarity"))).alias("raw"))


@query(f"with {TAGS}, {_IDF}, {_RAR}, {_COMB} select row_id, {q6('1 + 9 * greatest(0.0, least(raw, log2(greatest(t, 2)))) / log2(greatest(t, 2))')} as rarity from raw")
def rarity_absolute(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("row_id", r6(R.absolute(F.col("raw"), _n(spark, d))).alias("rarity"))


@query(f"with {TAGS}, {_IDF}, {_RAR}, {_COMB}, q as (select row_id, round(raw, 6) as v from raw) select row_id, {q6('1 + 9 * percent_rank() over (order by v)')} as rarity from q")
def rarity_percentile(spark: SparkSession, d: str) -> DataFrame:
    q = _raw(spark, d).select("row_id", F.round("raw", 6).alias("v"))
    return R.percentile_rank(q, "v", "rarity").select("row_id", r6(F.col("rarity")).alias("rarity"))



@query(f"with {SAMPLES} select row_id, {q6('least(0.5, 0.1 * case when row_id % 400 >= 200 then coalesce(score_confidence, 1.0) else 0.0 end * greatest(0.0, coalesce(rarity, 5.0) - 5))')} as bonus from samples")
def extension_bonus(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("row_id", r6(R.extension_bonus(F.coalesce("rarity", F.lit(5.0)), F.coalesce("score_confidence", F.lit(1.0)), F.col("row_id") % 400)).alias("bonus"))


_VAL = """(case when complexity is not null then .25 * complexity else 0.0 end + case when quality is not null then .4 * quality else 0.0 end + case when reasoning is not null then .2 * reasoning else 0.0 end{r})
  / nullif(case when complexity is not null then .25 else 0.0 end + case when quality is not null then .4 else 0.0 end + case when reasoning is not null then .2 else 0.0 end{w}, 0)"""
_VS = f"""v0 as (select *, {_VAL.format(r=' + .15 * coalesce(rarity, 5.0)', w=' + .15')} * case when quality < 4 then .7 else 1.0 end as b, {_VAL.format(r='', w='')} * case when quality < 4 then .7 else 1.0 end as pq,
  (complexity is not null)::int + (quality is not null)::int + (reasoning is not null)::int as k from samples),
  v1 as (select *, case when k >= 2 then greatest(1.0, least(10.0, case when b <= 5.5 then b else 5.5 + greatest(0.0, least(1.0, coalesce(score_confidence, 1.0))) * (b - 5.5) end)) end as value from v0)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    c = [F.col(k) for k in ("complexity", "quality", "reasoning")]
    return s.withColumn("value", V.value_score(*c, F.col("rarity"), F.col("score_confidence"))).withColumn("pure_quality", V.pure_quality(*c))


@query(f"with {SAMPLES}, {_VS} select row_id, {q6('value')} as value, {q6('pq')} as pure_quality from v1")
def value_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("row_id", r6(F.col("value")).alias("value"), r6(F.col("pure_quality")).alias("pure_quality"))


_SEL = f"""{_VS}, q as (select row_id, round(pq, 4) as q from v1 where pq is not null),
  g as (select row_id, q, ((rank() over (order by q) - 1) + (count(*) over (partition by q) - 1) / 2.0) / greatest(count(*) over () - 1, 1) as g from q),
  tg as (select row_id, dim, tag, greatest(max(confidence), .25) as c from tags group by all),
  j as (select tg.*, g.q, g.g, count(*) over (partition by dim, tag) as n, sum(c) over (partition by dim, tag) as s from tg join g using (row_id)),
  p as (select *, ((rank() over (partition by dim, tag order by q) - 1) + (count(*) over (partition by dim, tag, q) - 1) / 2.0) / greatest(n - 1, 1) as t from j where n >= 5),
  pd as (select row_id, dim, avg(c * (s / (s + 30) * t + (1 - s / (s + 30)) * g) + (1 - c) * g) as p, max(c) as c from p group by all),
  i as (select row_id, sum({W} * c * p) / sum({W} * c) as i from pd group by row_id),
  sel as (select g.row_id, g.g as g, 1 + 9 * coalesce(i.i, g.g) as intra from g left join i using (row_id))"""


@query(f"with {TAGS}, {_SEL} select row_id, {q6('g')} as global_pct, {q6('intra')} as intra_rank from sel")
def midrank_percentile(spark: SparkSession, d: str) -> DataFrame:
    s = V.selection_scores(_scored(spark, d).select("row_id", "pure_quality"), _long(spark, d), "row_id")
    return s.select("row_id", r6(F.col("global_pct")).alias("global_pct"), r6(F.col("intra_rank")).alias("intra_rank"))


_FIN = f"{_SEL}, fin as (select sel.row_id, greatest(1.0, least(10.0, (.49 * intra + .2 * (1 + 9 * g) + case when rarity is not null then .31 * rarity else 0.0 end) / (.69 + case when rarity is not null then .31 else 0.0 end))) as s from sel join samples using (row_id))"


def _selection(spark: SparkSession, d: str) -> DataFrame:
    sc = _scored(spark, d)
    s = V.selection_scores(sc.select("row_id", "pure_quality"), _long(spark, d), "row_id").join(sc.select("row_id", "rarity", "value"), "row_id")
    return s.withColumn("selection", V.compose_selection(F.col("intra_rank"), 1 + 9 * F.col("global_pct"), F.col("rarity")))


@query(f"with {TAGS}, {_FIN} select row_id, {q6('s')} as selection from fin")
def selection_score(spark: SparkSession, d: str) -> DataFrame:
    return _selection(spark, d).select("row_id", r6(F.col("selection")).alias("selection"))


@query(f"with {TAGS}, {_FIN}, o as (select row_id, {q6('s')} as selection from fin) select row_id, selection from o order by selection desc, row_id limit 100")
def selection_rank_topk(spark: SparkSession, d: str) -> DataFrame:
    return selection_score(spark, d).orderBy(F.desc("selection"), "row_id").limit(100)


@query(f"""with {TAGS}, {_VS}, b as (select dim, tag, max({q6('value')}) as m from tags join v1 using (row_id) where value is not null group by all), e as (select count(*) as tags from (select distinct dim, tag from tags)), t as (select unnest([4.0, 5.0, 6.0, 7.0])::double as threshold)
  select threshold, tags, count(*) filter (where m >= threshold) as retained, {q6('count(*) filter (where m >= threshold) / tags')} as coverage from b, e, t group by threshold, tags""")
def coverage_at_thresholds(spark: SparkSession, d: str) -> DataFrame:
    c = coverage_at(_long(spark, d), _scored(spark, d).where("value is not null").select("row_id", r6(F.col("value")).alias("value")), "row_id", "value", (4, 5, 6, 7))
    return c.withColumn("coverage", r6(F.col("coverage")))


@query(f"with {TAGS}, {_VS} select dim, tag, count(value) as n, {q6('avg(value)')} as mean_value from tags join v1 using (row_id) group by dim, tag")
def value_by_tag(spark: SparkSession, d: str) -> DataFrame:
    j = _long(spark, d).join(_scored(spark, d).select("row_id", "value"), "row_id")
    return j.groupBy("dim", "tag").agg(F.count("value").alias("n"), r6(F.avg("value")).alias("mean_value"))


_POOL = """known as (select dim, tag from tag_pool), al as (select dim, a.x as alias, min(tag) as tag from tag_pool, unnest(aliases) as a(x) group by all),
  own as (select tag, min(dim) as dim from tag_pool group by tag having count(distinct dim) = 1), d as (select dim, tag, count(*) as n from tags group by all),
  res as (select d.dim, d.tag, d.n, coalesce(k.tag, al.tag, d.tag) as canonical, case when k.tag is not null then 'pool' when al.tag is not null then 'alias' when own.dim is not null then 'rescue' else 'unmapped' end as how, own.dim as od
  from d left join known k on k.dim = d.dim and k.tag = d.tag left join al on al.dim = d.dim and al.alias = d.tag left join own on own.tag = d.tag)"""


@query(f"with {TAGS}, {_POOL} select dim, tag, n, canonical, case when how = 'rescue' then od else dim end as owner, how from res")
def alias_resolution(spark: SparkSession, d: str) -> DataFrame:
    return L.resolve_aliases(R.distribution(_long(spark, d)), table(spark, d, "tag_pool"))


@query(f"with {TAGS}, {_POOL} select dim, how, count(*) as tags, cast(sum(n) as bigint) as uses from res group by dim, how")
def validate_pool(spark: SparkSession, d: str) -> DataFrame:
    return alias_resolution(spark, d).groupBy("dim", "how").agg(F.count("*").alias("tags"), F.sum("n").alias("uses"))


@query("""select row_id, u.unnest.dimension as dimension, u.unnest."value" as tag from smoke_test_value, unnest(labels.unmapped) as u where length(u.unnest."value") <= 60 and len(u.unnest."value") - len(replace(u.unnest."value", ' ', '')) <= 3""")
def unmapped_events(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smoke_test_value").select("row_id", F.explode("labels.unmapped").alias("u"))
    return t.select("row_id", F.col("u.dimension").alias("dimension"), F.col("u.value").alias("tag")).where(L.unmappable(F.col("tag")))


@query("""with u as (select row_id, u.unnest.dimension as dimension, u.unnest."value" as tag from smoke_test_value, unnest(labels.unmapped) as u where u.unnest."value" is not null),
  r as (select *, count(*) over (partition by dimension, tag) as n, row_number() over (partition by dimension, tag order by row_id) as k from u) select dimension, tag, n, row_id, k from r where k <= 2""")
def unmapped_examples(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smoke_test_value").select("row_id", F.explode("labels.unmapped").alias("u")).select("row_id", F.col("u.dimension").alias("dimension"), F.col("u.value").alias("tag")).where("tag is not null")
    g = t.groupBy("dimension", "tag").agg(F.count("*").alias("n"), F.min("row_id").alias("r1"))
    rest = t.join(g.select(F.col("dimension").alias("x"), F.col("tag").alias("y"), "r1"), F.col("dimension").eqNullSafe(F.col("x")) & (F.col("tag") == F.col("y"))).where("row_id > r1").groupBy("dimension", "tag").agg(F.min("row_id").alias("r2"))
    j = g.join(rest.withColumnsRenamed({"dimension": "x", "tag": "y"}), F.col("dimension").eqNullSafe(F.col("x")) & (F.col("tag") == F.col("y")), "left")
    k = F.array(F.struct(F.col("r1").alias("row_id"), F.lit(1).cast("long").alias("k")), F.struct(F.col("r2").alias("row_id"), F.lit(2).cast("long").alias("k")))
    return j.select("dimension", "tag", "n", F.explode(k).alias("e")).select("dimension", "tag", "n", "e.row_id", "e.k").where("row_id is not null")


def _arr(d: str) -> str:
    return f"""coalesce(list_filter(labels."{d}", lambda x: x is not null and x <> ''), [])"""


def _lacks(d: str, *tags: str) -> str:
    return f"not list_has_any({_arr(d)}, [{', '.join(repr(t) for t in tags)}])"


#: The tables' own words for the intents and difficulties that the rules speak of.
_INTENTS, _LEVELS = {"make": "build", "mend": "debug", "ask": "learn", "judge": "review", "reshape": "modify"}, {"starter": "beginner", "deep": "expert"}


def _case(c: str, names: dict[str, str]) -> str:
    return f"case {c} {' '.join(f'when {k!r} then {v!r}' for k, v in names.items())} else coalesce({c}, '') end"


_I, _F, _C = _case("labels.intent", _INTENTS), _case("labels.difficulty", _LEVELS), "coalesce(labels.context, '')"
_RULES = {
    "learn-many-agentic": f"{_I} = 'learn' and len({_arr('agentic')}) > 3", "build-no-build-task": f"{_I} = 'build' and len({_arr('task')}) > 0 and {_lacks('task', *L.BUILD_TASKS)}", "beginner-many-concepts": f"{_F} = 'beginner' and len({_arr('concept')}) > 3",
    "beginner-constraints": f"{_F} = 'beginner' and len({_arr('constraint')}) > 0", "debug-no-bug-fixing": f"{_I} = 'debug' and len({_arr('task')}) > 0 and {_lacks('task', 'bug-fixing')}", "expert-no-concepts": f"{_F} = 'expert' and len({_arr('concept')}) = 0",
    "translation-one-language": f"list_contains({_arr('task')}, 'code-translation') and len({_arr('language')}) < 2", "ownership-no-rust": f"list_contains({_arr('concept')}, 'ownership') and not list_contains({_arr('language')}, 'rust')",
    "snippet-multi-file": f"{_C} = 'snippet' and list_contains({_arr('agentic')}, 'multi-file-coordination')", "review-no-review-task": f"{_I} = 'review' and len({_arr('task')}) > 0 and {_lacks('task', 'code-review-task')}", "modify-no-modify-task": f"{_I} = 'modify' and len({_arr('task')}) > 0 and {_lacks('task', *L.MODIFY_TASKS)}",
}


@query("select rule, count(*) as n from (" + " union all ".join(f"select '{k}' as rule from smoke_test_value where labels is not null and ({v})" for k, v in _RULES.items()) + ") group by rule")
def consistency_rules(spark: SparkSession, d: str) -> DataFrame:
    known = F.col("labels").withField("intent", F.expr(_I)).withField("difficulty", F.expr(_F))
    s = samples(spark, d).where("labels is not null").select(F.explode(L.consistency(known)).alias("rule"))
    return s.groupBy("rule").agg(F.count("*").alias("n"))


@query(f"""select row_id from smoke_test_value where labels is not null and list_has_any({_arr('domain')}, ['bakery-orders', 'ferry-ticketing', 'clinic-rotas']) and list_has_all({_arr('language')}, ['python'])""")
def trigger_match(spark: SparkSession, d: str) -> DataFrame:
    t = L.trigger(F.col("labels"), any_of={"domain": ["bakery-orders", "ferry-ticketing", "clinic-rotas"], "concept": []}, all_of={"language": ["python"]})
    return samples(spark, d).where(t).select("row_id")


@query("""with a as (select dim, tag, x.x as alias from tag_pool, unnest(aliases) as x(x)), tot as (select dim, count(*) as t from tag_pool group by dim)
  select 'tag-in-several-dims' as issue, tag as name, count(distinct dim) as n from tag_pool group by tag having count(distinct dim) > 1
  union all select 'alias-of-several-tags', alias, count(distinct dim || '|' || tag) from a group by alias having count(distinct dim || '|' || tag) > 1
  union all select 'alias-is-tag', alias, count(*) from a where alias in (select tag from tag_pool) group by alias
  union all select 'no-subcategory', dim, count(*) from tag_pool where subcategory is null group by dim
  union all select 'dominant-subcategory', dim || '/' || subcategory, count(*) from tag_pool join tot using (dim) where subcategory is not null group by dim, subcategory, t having count(*) > .8 * t""")
def taxonomy_checks(spark: SparkSession, d: str) -> DataFrame:
    return L.taxonomy_issues(table(spark, d, "tag_pool"))


@query(f"""with {SAMPLES}, e as (select row_id, unnest(map_entries(labels.confidence)) as e from samples where labels is not null) select e.key as dim, count(*) as n, {q6('avg(e.value)')} as mean, {q6('min(e.value)')} as lo, {q6('max(e.value)')} as hi, count(*) filter (where e.value < .6) as low from e where e.value is not null and not isnan(e.value) and e.value between 0 and 1 group by all""")
def confidence_stats(spark: SparkSession, d: str) -> DataFrame:
    e = samples(spark, d).where("labels is not null").select(F.explode(L.clean_confidence(F.col("labels.confidence"))).alias("dim", "v"))
    return e.groupBy("dim").agg(F.count("*").alias("n"), r6(F.avg("v")).alias("mean"), r6(F.min("v")).alias("lo"), r6(F.max("v")).alias("hi"), F.count_if(F.col("v") < 0.6).alias("low"))
