"""Queries over extension labels, stage features and comparisons of scorings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import extensions as E
from siltworks.operators import labels as L
from siltworks.operators import scorers as SC
from siltworks.plans.base import TAGS, q6, r6, samples, turns
from siltworks.plans.label_queries import _scored
from siltworks.plans.registry import query


def _long(spark: SparkSession, d: str) -> DataFrame:
    """The agentic and constraint tags as if they were an extension's fields."""
    t = L.tags_long(samples(spark, d), ["row_id"]).where("dim in ('agentic', 'constraint')")
    return t.select("row_id", F.lit("x").alias("spec"), F.lit("h").alias("spec_hash"), F.when(F.col("row_id") % 10 == 0, "invalid").otherwise("success").alias("status"), F.col("dim").alias("field"), F.col("tag").alias("value"), "confidence")


_E = f"with {TAGS}, x as (select row_id, dim as field, tag as value, confidence, case when row_id % 10 = 0 then 'invalid' else 'success' end as status from tags where dim in ('agentic', 'constraint'))"


@query(f"{_E} select 'x' as spec, 'h' as spec_hash, field, value, count(*) as n from x where status = 'success' group by field, value")
def extension_field_counts(spark: SparkSession, d: str) -> DataFrame:
    return E.field_counts(_long(spark, d))


@query(f"{_E} select 'x' as spec, status, count(distinct row_id) as n from x group by status")
def extension_status(spark: SparkSession, d: str) -> DataFrame:
    return E.status_counts(_long(spark, d), "row_id")


@query(f"""{_E}, ok as (select * from x where status = 'success'), t as (select count(distinct row_id) as total, count(distinct field) as nf from ok), c as (select field, value, greatest(0.0, log2(total / (count(*) + 1.0))) as idf from ok, t group by field, value, total),
  p as (select field, avg(idf) as prior from c group by field), f as (select row_id, field, .6 * max(idf) + .4 * avg(idf) as o, max(prior) as prior, max(confidence) as c from ok join c using (field, value) join p using (field) group by row_id, field),
  s as (select row_id, avg(c * o + (1 - c) * prior) as raw, avg(c) * count(*) / max(nf) as conf, max(total) as total from f, t group by row_id)
  select row_id, 'x' as spec, {q6('raw')} as raw, {q6('1 + 9 * greatest(0.0, least(raw, log2(greatest(total, 2)))) / log2(greatest(total, 2))')} as score, {q6('conf')} as confidence from s""")
def extension_rarity(spark: SparkSession, d: str) -> DataFrame:
    r = E.spec_rarity(_long(spark, d), "row_id")
    return r.select("row_id", "spec", r6(F.col("raw")).alias("raw"), r6(F.col("score")).alias("score"), r6(F.col("confidence")).alias("confidence"))





@query()
def tool_signatures(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("row_id", F.explode("turns").alias("t"))
    calls = t.select("row_id", F.explode(F.regexp_extract_all("t.value", F.lit(r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"), 1)).alias("call"))
    return calls.groupBy(SC.tool_signature(F.col("call")).alias("signature")).agg(F.count("*").alias("n"))


@query(f"with {TAGS}, v as (select row_id, case when row_id % 13 = 0 then null else cast(1 + row_id * 7 % 10 as double) end as b, case when row_id % 17 = 0 then null else cast(1 + row_id % 10 as double) end as a from samples) select count(*) as n, count(*) filter (where b >= 8) as before_ge_8, count(*) filter (where a >= 8) as after_ge_8, count(*) filter (where b <= 3) as before_le_3, count(*) filter (where a <= 3) as after_le_3 from v")
def selection_compare(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return SC.threshold_shift(SC.compare_selection(s.select("row_id", F.col("quality").alias("selection")), s.select("row_id", F.col("complexity").alias("selection")), "row_id"))
