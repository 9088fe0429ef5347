"""Queries over conversations as units, extension scores, records, taxonomy checks, conversions and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import normalize as N
from siltworks.functions import text as T
from siltworks.operators import clustering as CL
from siltworks.operators import labels as L
from siltworks.operators import rarity as R
from siltworks.operators import units as U
from siltworks.plans import sqltext as Q
from siltworks.plans.base import DERIVED, SAMPLES, SLICES, TAGS, TURNS, q6, r6, samples, slices, turns
from siltworks.plans.registry import query
from siltworks.session import table

_DIMS = ("intent", "difficulty", "context", "language", "domain", "task", "concept", "agentic", "constraint")
_LISTS = _DIMS[3:]


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows by id: rows of one id are a conversation's slices in the order of their delivery."""
    t = table(spark, d, "smoke_test_value").select("row_id", F.coalesce("id", F.concat(F.lit("r"), F.col("row_id").cast("string"))).alias("ck"), "ingested_at", "labels")
    return t.select("*", *[F.expr(DERIVED[k]).alias(k) for k in ("inherited", "partial")])


_DEL = f"d as (select row_id, coalesce(id, 'r' || row_id) as ck, ingested_at, labels, {DERIVED['inherited']} as inherited, {DERIVED['partial']} as partial from smoke_test_value)"
_SOME = {d: "true" if d not in _LISTS else f"""len(list_filter(coalesce(labels."{d}", []), lambda x: x is not null and x <> '')) > 0""" for d in _DIMS}
_CONF = " union all ".join(f"select ck, ingested_at, row_id, inherited, '{d}' as dim, labels.confidence['{d}'] as c from d where labels is not null and {_SOME[d]}" for d in _DIMS)


@query(f"""with {_DEL}, c as (select * from ({_CONF}) where c is not null and not isnan(c) and c between 0 and 1), g as (select ck, dim, arg_max(c, (ingested_at, row_id)) as last, avg(c) filter (where not inherited) as own, avg(c) filter (where inherited) as other from c group by all)
  select ck, dim, {q6("case when dim in ('intent', 'difficulty', 'context') then last else coalesce(own, other) end")} as confidence from g""")
def conversation_confidence(spark: SparkSession, d: str) -> DataFrame:
    c = U.dimension_confidence(_delivered(spark, d), "ck", ["ingested_at", "row_id"])
    return c.select("ck", "dim", r6(F.col("confidence")).alias("confidence"))


@query(f"""with {_DEL}, u as (select ck, row_id, ingested_at, u.unnest.dimension as dimension, u.unnest."value" as value from d, unnest(labels.unmapped) as u) select ck, coalesce(dimension, 'unknown') as dimension, coalesce(value, '?') as value, arg_min(row_id, (ingested_at, row_id)) as first_row from u group by all""")
def conversation_unmapped(spark: SparkSession, d: str) -> DataFrame:
    u = U.merged_unmapped(_delivered(spark, d), "ck", ["ingested_at", "row_id"])
    return u.select("ck", "dimension", "value", F.col("first.row_id").alias("first_row"))


@query(f"with {_DEL} select ck, count(*) as slices, count(*) filter (where labels is not null and not partial and not inherited) as observed, count(*) filter (where labels is not null and not partial and inherited) as inherited from d group by ck")
def conversation_label_units(spark: SparkSession, d: str) -> DataFrame:
    return U.label_sources(_delivered(spark, d), "ck")


_LAST = ", ".join(f"arg_max(labels.{k}, (ingested_at, row_id)) filter (where labels.{k} is not null and labels.{k} <> '') as {k}" for k in _DIMS[:3])


@query(f"with {_DEL} select ck, {_LAST} from d group by ck")
def conversation_merged_labels(spark: SparkSession, d: str) -> DataFrame:
    from siltworks.operators.conversation import merge_labels

    s = _delivered(spark, d).select("ck", "ingested_at", "row_id", *[F.col(f"labels.{k}").alias(k) for k in _DIMS[:3]])
    return merge_labels(s, "ck", ["ingested_at", "row_id"], list(_DIMS[:3]), [])


def _extension(spark: SparkSession, d: str) -> DataFrame:
    long = _delivered(spark, d).select("ck", "ingested_at", "row_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"labels.{f}").alias("v"), F.try_element_at("labels.confidence", F.lit(f)).alias("c")) for f in ("agentic", "constraint")])).alias("e"))
    return long.select("ck", "ingested_at", "row_id", F.lit("x").alias("spec"), F.col("e.field").alias("field"), F.when(~F.isnan("e.c"), F.col("e.c")).alias("confidence"), F.explode("e.v").alias("value"))


_EXT = " union all ".join(f"""select ck, ingested_at, row_id, '{f}' as field, case when not isnan(labels.confidence['{f}']) then labels.confidence['{f}'] end as confidence, u.t as value from d, unnest(labels."{f}") as u(t)""" for f in ("agentic", "constraint"))
_MERGED = f"""{_DEL}, e as (select * from ({_EXT}) where value is not null and value <> ''), f as (select ck, field, value, min((ingested_at, row_id)) as fa, sum(confidence) as s, count(confidence) as c from e group by all),
  g as (select ck, field, list(value order by fa, value) as vs, sum(s) / sum(c) as confidence from f group by all)"""


@query(f"with {_MERGED} select ck, 'x' as spec, field, array_to_string(vs, ',') as \"values\", {q6('confidence')} as confidence from g")
def extension_conversation_units(spark: SparkSession, d: str) -> DataFrame:
    m = U.merged_extensions(_extension(spark, d), "ck", ["ingested_at", "row_id"])
    return m.select("ck", "spec", "field", F.array_join("values", ",").alias("values"), r6(F.col("confidence")).alias("confidence"))


@query(f"with {_MERGED}, v as (select field, confidence, unnest(vs) as value from g) select 'x' as spec, field, value, count(*) as units, {q6('avg(confidence)')} as confidence from v group by field, value")
def extension_unit_stats(spark: SparkSession, d: str) -> DataFrame:
    s = U.extension_statistics(U.merged_extensions(_extension(spark, d), "ck", ["ingested_at", "row_id"]))
    return s.select("spec", "field", "value", "units", r6(F.col("confidence")).alias("confidence"))


@query(f"with {TAGS}, v as (select dim as field, tag as value, row_id, source_file from tags join samples using (row_id) where dim in ('agentic', 'constraint')), p as (select source_file, field, value, count(*) as n from v group by all) select field, value, sum(n)::bigint as n from p group by all")
def extension_stats_merged(spark: SparkSession, d: str) -> DataFrame:
    """Counts by file, merged over the files."""
    from siltworks.operators.stats import merge_counts

    long = L.tags_long(samples(spark, d), ["row_id", "source_file"]).where("dim in ('agentic', 'constraint')")
    per = long.groupBy("source_file", F.col("dim").alias("field"), F.col("tag").alias("value")).agg(F.count("*").alias("n"))
    return merge_counts([per.drop("source_file")], ["field", "value"])


_GATE = "case when row_id % 400 >= 200 then greatest(0.0, least(1.0, coalesce(score_confidence, 0.0))) else 0.0 end"
_EXTENSION = "1 + row_id * 3 % 10"
_BONUS = f"least(0.5, 0.1 * {_GATE} * greatest(0.0, {_EXTENSION} - 5))"
_R2 = f"case when rarity is not null then greatest(1.0, least(10.0, rarity + {_BONUS})) end"


def _extended(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    return s.withColumn("r2", U.extended_rarity(F.col("rarity"), F.expr(f"cast({_EXTENSION} as double)"), F.col("score_confidence"), F.col("row_id") % 400))


@query(f"with {SAMPLES} select row_id, {q6(_R2)} as score, {q6(_BONUS)} as bonus, {q6(_GATE)} as gate from samples")
def rarity_v2(spark: SparkSession, d: str) -> DataFrame:
    return _extended(spark, d).select("row_id", *[r6(F.col(f"r2.{c}")).alias(c) for c in ("score", "bonus", "gate")])


_W2 = "case when complexity is not null then .25 else 0.0 end + case when quality is not null then .4 else 0.0 end + case when reasoning is not null then .2 else 0.0 end"
_B2 = f"(coalesce(.25 * complexity, 0.0) + coalesce(.4 * quality, 0.0) + coalesce(.2 * reasoning, 0.0) + .15 * coalesce(r2, 5.0)) / ({_W2} + .15) * case when quality < 4 then .7 else 1.0 end"


@query(f"with {SAMPLES}, x as (select *, {_R2} as r2 from samples), y as (select *, {_B2} as b, (complexity is not null)::int + (quality is not null)::int + (reasoning is not null)::int as k from x) select row_id, {q6('case when k >= 2 then greatest(1.0, least(10.0, case when b <= 5.5 then b else 5.5 + greatest(0.0, least(1.0, coalesce(score_confidence, 1.0))) * (b - 5.5) end)) end')} as value, {q6('greatest(1.0, least(10.0, (.49 * 6 + .2 * quality + case when r2 is not null then .31 * r2 else 0.0 end) / (.69 + case when r2 is not null then .31 else 0.0 end)))')} as selection from y where quality is not null")
def scores_v2(spark: SparkSession, d: str) -> DataFrame:
    s = _extended(spark, d).where("quality is not null")
    v = U.second_scores(F.col("complexity"), F.col("quality"), F.col("reasoning"), F.col("r2.score"), F.col("score_confidence"), F.lit(6.0), F.col("quality"))
    return s.select("row_id", r6(v["value"]).alias("value"), r6(v["selection"]).alias("selection"))


@query(f"""with {SAMPLES}, x as (select *, coalesce(id, 'r' || row_id) as ck, {_R2} as r2 from samples), g as (select ck, count(r2) as seen, avg(case when r2 is not null then greatest(0.0, r2 - rarity) end) as m, max(case when r2 is not null then greatest(0.0, r2 - rarity) end) as p, avg(coalesce(score_confidence, 1.0)) as c from x group by ck)
  select ck, {q6('case when seen > 0 then greatest(1.0, least(10.0, 4.0 + (.7 * m + .3 * p) * greatest(0.0, least(1.0, c)))) end')} as conv_rarity_extension from g""")
def conv_rarity_extension(spark: SparkSession, d: str) -> DataFrame:
    x = _extended(spark, d).select(F.coalesce("id", F.concat(F.lit("r"), F.col("row_id").cast("string"))).alias("ck"), "rarity", F.col("r2.score").alias("extended"), F.lit(1.0).alias("weight"), F.lit(4.0).alias("conv"), F.col("score_confidence").alias("confidence"))
    c = U.conversation_extension_rarity(x, "ck", "rarity", "extended", "conv")
    return c.select("ck", r6(F.col("conv_rarity_extension")).alias("conv_rarity_extension"))


_CID = "coalesce(nullif(source_id, ''), concat_ws('::row:', id, cast(row_id as varchar)))"
_ST = f"one as (select {_CID} as conversation_id, case when coalesce(source_file, '') <> '' then concat_ws('::', source_file, {_CID}) else {_CID} end as conversation_key, source_file, 1::bigint as turn_count, value as conv_value, rarity as conv_selection, rarity as conv_rarity, case when inherited then 0.0 else 1.0 end::double as observed_turn_ratio, score_confidence as rarity_confidence from slices where coalesce(total_turns, 1) <= 1)"


def _singles(spark: SparkSession, d: str) -> DataFrame:
    s = slices(spark, d).where("coalesce(total_turns, 1) <= 1").withColumn("conversation_uid", F.lit(None).cast("string"))
    return U.single_turn_records(s.withColumn("selection", F.col("rarity")).withColumn("confidence", F.col("score_confidence")))


@query(f"with {SLICES}, {_ST} select conversation_id, conversation_key, source_file, turn_count, conv_value, conv_rarity, observed_turn_ratio, rarity_confidence from one")
def single_turn_records(spark: SparkSession, d: str) -> DataFrame:
    return _singles(spark, d).select("conversation_id", "conversation_key", "source_file", "turn_count", "conv_value", "conv_rarity", "observed_turn_ratio", "rarity_confidence")


@query(f"with {SLICES}, {_ST}, k as (select conversation_key from one where conversation_key is not null union select conversation_key from conversation_scores where conversation_key is not null) select count(*) as records, (select count(*) from (select conversation_key from conversation_scores where conversation_key is not null and turn_count > 1 group by 1)) as multi from k")
def merged_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of an earlier run and of single turns as one set."""
    old = table(spark, d, "conversation_scores").where("conversation_key is not null").select("conversation_key", F.col("turn_count").cast("long").alias("turn_count"), "conv_value", "conv_selection")
    new = _singles(spark, d).where("conversation_key is not null").select("conversation_key", "turn_count", "conv_value", "conv_selection")
    return U.merge_records([old, new]).agg(F.count("*").alias("records"), F.count_if(F.col("turn_count") > 1).alias("multi"))


@query(f"with {SAMPLES}, e as (select row_id, unnest(map_entries(labels.confidence)) as e from samples where labels is not null), f as (select row_id, min((e.value, e.key)) as m from e where e.value is not null and not isnan(e.value) and e.value between 0 and 1 group by row_id) select row_id, m[2] as dim, m[1] as confidence from f".replace("min((e.value, e.key)) as m", "min({'c': e.value, 'k': e.key}) as m").replace("m[2] as dim, m[1] as confidence", "m.k as dim, m.c as confidence"))
def least_confidence(spark: SparkSession, d: str) -> DataFrame:
    m = samples(spark, d).where("labels is not null").select("row_id", L.min_confidence(F.col("labels.confidence")).alias("m"))
    return m.where("m is not null").select("row_id", F.col("m.dim").alias("dim"), F.col("m.confidence").alias("confidence"))


@query(f"with {TAGS}, f as (select distinct row_id, unnest([tag, dim || ':' || tag]) as t from tags) select row_id, string_agg(t, ' ' order by t) as tags from f group by row_id")
def flat_tags(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d).where("labels is not null").select("row_id", L.flat_tags(F.col("labels")).alias("t"))
    return s.where(F.size("t") > 0).select("row_id", F.array_join("t", " ").alias("tags"))


@query("""with a as (select dim, tag, unnest(aliases) as alias from tag_pool) select 'lacks-required-field' as issue, coalesce(tag, '') as name from tag_pool where tag is null or tag = '' or dim is null or dim = ''
  union all select 'unknown-dimension', tag from tag_pool where dim not in ('intent', 'difficulty', 'context', 'language', 'domain', 'task', 'concept', 'agentic', 'constraint')
  union all select 'lacks-subcategory', tag from tag_pool where subcategory is null and dim in (select dim from tag_pool where subcategory is not null)
  union all select 'subcategory-in-several-dims', subcategory from tag_pool where subcategory is not null group by subcategory having count(distinct dim) > 1
  union all select 'alias-not-lowercase', alias from a where alias <> lower(alias) union all select 'alias-too-long', alias from a where length(alias) > 200""")
def taxonomy_schema(spark: SparkSession, d: str) -> DataFrame:
    return L.pool_issues(table(spark, d, "tag_pool"))


@query("""with n as (select tag as n, dim from tag_pool union select unnest(aliases), dim from tag_pool), g as (select n, min(dim) as dim from n group by n), u as (select u.unnest."value" as value, count(*) as uses from smoke_test_value, unnest(labels.unmapped) as u where u.unnest."value" is not null group by 1)
  select value, uses, g.dim as guess from u left join g on g.n = u.value""")
def guessed_dimensions(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "smoke_test_value").select(F.explode("labels.unmapped").alias("u")).select(F.col("u.value").alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("uses"))
    return L.guessed_dimension(u, table(spark, d, "tag_pool"))


_BASE = "b as (select labels.intent as tag, count(*) as n from smoke_test_value where labels.intent <> '' group by 1), t as (select count(*) as t from smoke_test_value where labels is not null), i as (select tag, greatest(0.0, log2(t / (n + 1.0))) as idf from b, t), p as (select avg(idf) as prior from i)"


@query(f"with {_BASE} select row_id, {q6('coalesce(i.idf, p.prior)')} as rarity from conversation_duplicate_source_id c left join i on i.tag = c.labels.intent, p where c.labels.intent <> ''")
def rarity_external_baseline(spark: SparkSession, d: str) -> DataFrame:
    """Slices of one table by the tag counts of another; tags that these lack count as the dimension's prior."""
    base = samples(spark, d).where("labels is not null")
    long = L.tags_long(base, ["row_id"], inherited=None).where("dim = 'intent'")
    t = R.idf_table(R.distribution(long), base.count())
    own = slices(spark, d).where("intent <> ''").select("row_id", F.lit("intent").alias("dim"), F.col("intent").alias("tag"), F.lit(1.0).alias("confidence"))
    return R.sample_rarity(own.withColumn("confidence", F.lit(1.0)), t, "row_id").select("row_id", r6(F.col("tag_rarity")).alias("rarity"))


@query(f"with {SAMPLES} select 'hybrid' as mode, count(*) as combos from (select distinct labels.intent from samples where labels.intent <> '')")
def combo_baseline(spark: SparkSession, d: str) -> DataFrame:
    """Without external combination counts the batch's own are taken."""
    own = samples(spark, d).where("labels.intent <> ''").groupBy(F.col("labels.intent").alias("combo")).agg(F.count("*").alias("n"))
    counts, mode = R.combo_baseline(own.limit(0), own)
    return counts.agg(F.count("*").alias("combos")).select(F.lit(mode).alias("mode"), "combos")


@query("select count(*) as n from conversation_duplicate_source_id s where metadata.source_id is not null and not exists (select 1 from conversation_scores t where t.conversation_id = s.metadata.source_id)")
def resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Slices whose conversation has no record of an earlier run."""
    from siltworks.operators.lookups import resume

    done = table(spark, d, "conversation_scores").select(F.col("conversation_id").alias("source_id")).where("source_id is not null")
    return resume(slices(spark, d).select("source_id").where("source_id is not null"), done, "source_id").agg(F.count("*").alias("n"))


@query(rf"with {TURNS} select row_id, pos::bigint as pos, {Q.strip('value')} as text, {Q.without_cot('value')} as reply, length({Q.sanitized('value')}) as clean_chars from turns where role = 'gpt'".replace(f"{Q.strip('value')} as text, ", ""))
def cot_and_sanitize(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("row_id", F.posexplode("turns").alias("pos", "t")).where("t.from = 'gpt'")
    return t.select("row_id", (F.col("pos") + 1).cast("long").alias("pos"), N.strip_cot(F.col("t.value")).alias("reply"), F.length(N.sanitize(F.col("t.value"))).cast("long").alias("clean_chars"))


_BLOCK = r"regexp_extract_all(value, '(?s)<(?:think|thinking)>(.*?)</(?:think|thinking)>', 1)"
_TOKEN = r"regexp_extract_all(value, '(?s)\[unused16\](.*?)\[unused17\]', 1)"


@query(f"with {TURNS}, b as (select row_id, pos, unnest(list_concat({_BLOCK}, {_TOKEN})) as t, unnest(range(len({_BLOCK}) + len({_TOKEN}))) as i from turns where role = 'gpt'), s as (select row_id, pos, i, {Q.strip('t')} as t from b) select row_id, string_agg(t, chr(10) || chr(10) order by pos, i) as cot from s where t <> '' group by row_id")
def conversation_cot(spark: SparkSession, d: str) -> DataFrame:
    c = turns(spark, d).select("row_id", N.conversation_cot(F.col("turns")).alias("cot"))
    return c.where("cot <> ''")


_THINK = rf"regexp_replace(regexp_replace(value, '(?s)<think>\s*</think>', '', 'g'), '(?s)<think>\s*(.*?)\s*</think>', '[unused16]\1[unused17]', 'g')"


@query(f"with {TURNS} select coalesce(nullif(id, ''), 'hf-' || row_id) as id, row_id, pos::bigint as pos, case role when 'human' then 'user' when 'gpt' then 'assistant' else role end as role, case when role = 'gpt' then {_THINK} else value end as content from turns")
def converted_tokens(spark: SparkSession, d: str) -> DataFrame:
    c = turns(spark, d).select("row_id", N.token_form(F.col("id"), F.col("turns"), F.concat(F.lit("hf-"), F.col("row_id").cast("string"))).alias("c"))
    return c.select("row_id", F.col("c.id").alias("id"), F.posexplode("c.data").alias("p", "m")).select("id", "row_id", (F.col("p") + 1).cast("long").alias("pos"), "m.role", "m.content")


@query(f"with {TURNS} select coalesce(nullif(id, ''), 'hf-' || row_id) as id, count(*) as turns, count(*) filter (where role = 'human') as human, count(*) filter (where role = 'gpt') as gpt, sum(length(value))::bigint as chars from turns group by id, row_id")
def conversion_stats(spark: SparkSession, d: str) -> DataFrame:
    c = turns(spark, d).select(N.chat_form(F.col("id"), F.col("turns"), F.concat(F.lit("hf-"), F.col("row_id").cast("string"))).alias("c")).select("c.*")
    n = lambda r: F.size(F.filter("conversations", lambda t: t["from"] == r)).cast("long")
    return c.select("id", F.size("conversations").cast("long").alias("turns"), n("human").alias("human"), n("gpt").alias("gpt"), F.aggregate("conversations", F.lit(0).cast("long"), lambda a, t: a + F.length(t["value"])).alias("chars"))


@query("with r as (select label, max((embedding[1]::double, vec_id)) as b from embeddings group by label) select e.vec_id as window_id, e.label as cluster, len(e.embedding)::bigint as dim from embeddings e join r on r.label = e.label and r.b = (e.embedding[1]::double, e.vec_id)")
def cluster_export(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "embeddings").select(F.col("vec_id").alias("window_id"), "embedding")
    m = table(spark, d, "embeddings").select(F.col("vec_id").alias("window_id"), F.col("label").alias("cluster"), F.element_at("embedding", 1).cast("double").alias("x"))
    out = CL.export_clusters(CL.representatives(m, "cluster", ["x", "window_id"]), w)
    return out.select("window_id", "cluster", F.size("embedding").cast("long").alias("dim"))


_PLANES = ", ".join(f"({i}, [{', '.join(repr(float(x)) for x in p)}])" for i, p in enumerate(CL.hyperplanes(64, 64, 42)))
_BITS = f"p(i, v) as (values {_PLANES}), h as (select vec_id, i, (list_dot_product(embedding::double[], v) >= 0)::int as bit from embeddings, p where embedding is not null)"


@query(f"with {_BITS} select vec_id, (i // 8)::bigint as band, sum(bit << (i % 8))::bigint as value from h group by vec_id, i // 8")
def semhash_bands(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", "embedding").where("embedding is not null")
    b = CL.semhash(v, "vec_id", dim=64, bits=64).select("vec_id", F.posexplode(CL.bands(F.col("hash"), 64, 8)).alias("band", "value"))
    return b.select("vec_id", F.col("band").cast("long").alias("band"), F.col("value").cast("long").alias("value"))


_KNN = f"""{_BITS}, w as (select vec_id, list(bit order by i) as bits, array_to_string(list(bit order by i), '') as h from h group by vec_id), g as (select h, min(vec_id) as rep from w group by h),
  n as (select w.vec_id as k, bits, embedding::double[] as e from w join g on g.rep = w.vec_id join embeddings using (vec_id)),
  c as (select a.k as a, b.k as b, list_dot_product(a.e, b.e) as s from n a join n b on a.k <> b.k where len(list_filter(range(8), lambda i: a.bits[i * 8 + 1:i * 8 + 8] = b.bits[i * 8 + 1:i * 8 + 8])) > 0 and list_sum(list_transform(range(1, 65), lambda i: (a.bits[i] <> b.bits[i])::int)) <= 28),
  t as (select *, row_number() over (partition by a order by s desc, b desc) as r from c where s >= .35)"""


@query(f"with {_KNN} select a, b, {q6('s')} as similarity from t where r <= 32 union all select w.vec_id, g.rep, 1.0 from w join g using (h) where w.vec_id <> g.rep")
def knn_edges(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", "embedding").where("embedding is not null")
    e = CL.neighbours(v, CL.semhash(v, "vec_id", dim=64, bits=64), "vec_id", radius=28, cosine=0.35, n_bands=8, bits=64)
    return e.select("a", "b", r6(F.col("similarity")).alias("similarity"))


@query("with d as (select doc_id, source, md5(doc_id || ':42') as h from documents) select doc_id, source from d order by h, doc_id limit 100")
def seeded_sample_rows(spark: SparkSession, d: str) -> DataFrame:
    """A sampling operator: 100 rows by hash."""
    from siltworks.sources.readers import seeded_sample

    return seeded_sample(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 100)


@query("with d as (select doc_id, lang, md5(doc_id || ':42') as h from documents where lang is not null), r as (select *, row_number() over (partition by lang order by h, doc_id) as r from d) select doc_id, lang from r order by r > greatest(3, 200 // (select count(distinct lang) from d)), h, doc_id limit 200")
def stratified_sample_rows(spark: SparkSession, d: str) -> DataFrame:
    """A sampling operator: rows of each language by hash."""
    from siltworks.sources.readers import stratified_sample

    return stratified_sample(table(spark, d, "documents").where("lang is not null").select("doc_id", "lang"), "doc_id", "lang", 200)


@query(f"with {TURNS}, s as (select row_id, pos, length(value) as l, coalesce(sum(length(value)) over (partition by row_id order by pos rows between unbounded preceding and 1 preceding), 0) as before from turns), k as (select row_id, l, greatest(1500 - before, 0) as room from s) select row_id, count(*) filter (where room > 0) as n_kept, sum(case when l <= room then l when room < {len(T.MARKER) + 300} then room else greatest(case when room - floor(room * .3) - {len(T.MARKER)} < 200 then room - 200 - {len(T.MARKER)} else floor(room * .3) end, 100) + {len(T.MARKER)} + greatest(room - floor(room * .3) - {len(T.MARKER)}, 200) end)::bigint as chars from k group by row_id")
def truncated_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Turns within a budget of 1500 characters."""
    t = turns(spark, d).select("row_id", T.truncate_turns(F.col("turns"), 1500).alias("kept"))
    return t.select("row_id", F.size("kept").cast("long").alias("n_kept"), F.aggregate("kept", F.lit(0).cast("long"), lambda a, x: a + F.length(x["value"])).alias("chars"))


@query(f"with {TURNS}, t as (select row_id, string_agg(value, chr(10) order by pos) as t from turns group by row_id) select row_id, array_to_string({Q.fences('t')}, ',') as fences, array_to_string({Q.present(['case when ' + Q.any_of('lower(t)', [n for n, m in T.FRAMEWORKS.items() if m == lang]) + ' then ' + Q.lit(lang) + ' end' for lang in sorted(set(T.FRAMEWORKS.values()))])}, ',') as frameworks from t")
def language_signals(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("row_id", F.array_join(F.transform("turns", lambda x: x["value"]), "\n").alias("t"))
    return t.select("row_id", F.array_join(T.fence_languages(F.col("t")), ",").alias("fences"), F.array_join(T.framework_languages(F.col("t")), ",").alias("frameworks"))


@query(f"with {TURNS} select row_id, (sum(length(value)) % 10 + 1)::bigint as overall from turns group by row_id")
def external_scorer(spark: SparkSession, d: str) -> DataFrame:
    """The scorer boundary with a deterministic stand-in: length of the conversation as a score."""
    import pandas as pd

    from siltworks.operators import scorers as SC

    def call(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row_id": f["row_id"], "overall": (f["chars"] % 10 + 1).astype("int64")})

    t = turns(spark, d).select("row_id", F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + F.length(x["value"])).alias("chars"))
    return SC.external(t, call, "row_id long, overall long")


_STEPS = "['shell-steps', 'test-loop', 'doc-lookup']"


@query(f"""with a as (select row_id, list_distinct(list_filter(coalesce(labels.agentic, []), lambda x: x is not null and x <> '')) as a from smoke_test_value where labels is not null and list_has_any(list_filter(coalesce(labels."language", []), lambda x: x is not null and x <> ''), ['python', 'go', 'rust']))
  select row_id, 'success' as status, len(list_filter(a, lambda x: list_contains({_STEPS}, x)))::bigint as n_known, len(list_filter(a, lambda x: not list_contains({_STEPS}, x)))::bigint as n_unmapped from a""")
def extension_validation(spark: SparkSession, d: str) -> DataFrame:
    """The agentic tags as a reply, against a spec that knows a few of them."""
    from siltworks.operators import extensions as E

    spec = E.Spec("steps", "1", {"steps": ("shell-steps", "test-loop", "doc-lookup")}, multi=("steps",), any_of={"language": ("python", "go", "rust")})
    s = samples(spark, d).where(E.matches(spec, F.col("labels")))
    v = E.validated(spec, F.create_map(F.lit("steps"), F.coalesce("labels.agentic", F.array().cast("array<string>"))))
    return s.select("row_id", v["status"].alias("status"), F.size(v["labels"]["steps"]).cast("long").alias("n_known"), F.size(v["unmapped"]).cast("long").alias("n_unmapped"))


_FLAGS = "list_filter([case when row_id % 2 = 0 then 'has-bug' end, case when row_id % 3 = 0 then 'made-up' end, case when row_id % 5 = 0 then 'excellent-explanation' end], lambda x: x is not null)"
_OV = "case when 1 + row_id * 7 % 12 between 1 and 10 then 1 + row_id * 7 % 12 end"
_CO = "case when row_id % 14 between 1 and 10 then row_id % 14 end"


@query(f"with x as (select row_id, {_CO} as c, {_OV} as o, 1 + row_id % 10 as p, {_FLAGS} as f from smoke_test_value), y as (select *, case when o > c + 2 then c + 2 else o end as t, (coalesce(c, 0) + p) / (case when c is null then 1.0 else 2.0 end) as m from x) select row_id, (case when abs(t - m) > 2 then round_even(m, 0) else t end)::bigint as overall, len(list_filter(f, lambda v: v in ('has-bug', 'excellent-explanation')))::bigint as known, len(list_filter(f, lambda v: v not in ('has-bug', 'excellent-explanation')))::bigint as unknown from y")
def score_validation(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    f = F.array_compact(F.array(F.when(r % 2 == 0, "has-bug"), F.when(r % 3 == 0, "made-up"), F.when(r % 5 == 0, "excellent-explanation")))
    k = L.known_flags(f, ("has-bug", "excellent-explanation"))
    v = L.validate_scores(F.array(r % 14, 1 + r % 10), 1 + r * 7 % 12, r % 14)
    return table(spark, d, "smoke_test_value").select("row_id", v.cast("long").alias("overall"), F.size(k["known"]).cast("long").alias("known"), F.size(k["unknown"]).cast("long").alias("unknown"))
