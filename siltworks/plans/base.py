"""Inputs that several queries share, as DataFrames and as SQL: the tables lack scores, so these derive from row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.slicing import conversations
from siltworks.session import spread, table


def r6(c: Column) -> Column:
    """Six digits, equal in both engines; the small addend takes ties upwards in either."""
    return (c + F.lit(1e-9)).cast("decimal(24,6)").cast("double")


def q6(x: str) -> str:
    return f"cast(cast({x} + 1e-9::double as decimal(24,6)) as double)"


#: Scores and flags derived from row ids, in expressions that both engines read alike.
DERIVED = {
    "complexity": "case when row_id % 17 = 0 then null else cast(1 + row_id % 10 as double) end",
    "quality": "case when row_id % 13 = 0 then null else cast(1 + row_id * 7 % 10 as double) end",
    "reasoning": "case when row_id % 19 = 0 then null else cast(1 + row_id * 3 % 10 as double) end",
    "score_confidence": "case when row_id % 7 = 0 then null else cast(row_id % 5 as double) / 4 end",
    "rarity": "case when row_id % 23 = 0 then null else cast(1 + row_id * 5 % 19 as double) / 2 end",
    "inherited": "row_id % 11 = 0",
    "partial": "row_id % 29 = 0",
    "correctness": "case when row_id % 6 = 0 then null else 1 + row_id % 10 end",
    "thinking_mode": "case when row_id % 4 = 0 then 'slow' when row_id % 4 = 1 then 'fast' when row_id % 4 = 2 then '' end",
}


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "smoke_test_value").select("row_id", "id", "labels", F.col("metadata.source_file").alias("source_file"))
    return t.select("*", *[F.expr(e).alias(k) for k, e in DERIVED.items()])


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spread(table(spark, sf_dir, "smoke_test").select("row_id", "id", "conversations", "metadata")))


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored slices, one row per delivered row."""
    t = table(spark, sf_dir, "conversation_duplicate_source_id")
    out = t.select("row_id", "id", F.col("metadata.source_id").alias("source_id"), F.col("metadata.turn_index").cast("long").alias("turn_index"), F.col("metadata.total_turns").cast("long").alias("total_turns"), F.col("metadata.source_file").alias("source_file"), F.col("labels.intent").alias("intent"), F.when(~F.isnan("value.value_score"), F.col("value.value_score")).alias("value"))
    return out.select("*", *[F.expr(DERIVED[k]).alias(k) for k in ("quality", "score_confidence", "rarity", "inherited", "thinking_mode")], F.expr("row_id % 3 = 0").alias("agentic"), F.expr("case when row_id % 10 = 0 then 1 else 0 end").alias("n_flags"))


_D = ", ".join(f"{e} as {k}" for k, e in DERIVED.items())
SAMPLES = f"samples as (select row_id, id, labels, metadata.source_file as source_file, {_D} from smoke_test_value)"
_S = ", ".join(f"{DERIVED[k]} as {k}" for k in ("quality", "score_confidence", "rarity", "inherited", "thinking_mode"))
SLICES = f"""slices as (select row_id, id, metadata.source_id as source_id, cast(metadata.turn_index as bigint) as turn_index, cast(metadata.total_turns as bigint) as total_turns,
  metadata.source_file as source_file, labels.intent as intent, case when not isnan(value.value_score) then value.value_score end as value, {_S}, row_id % 3 = 0 as agentic, case when row_id % 10 = 0 then 1 else 0 end as n_flags
  from conversation_duplicate_source_id)"""
_SINGLE = " union all ".join(f"select row_id, labels, inherited, '{d}' as dim, labels.{d} as tag from samples where labels is not null" for d in ("intent", "difficulty", "context"))
_MULTI = " union all ".join(f"select row_id, labels, inherited, '{d}' as dim, u.t as tag from samples, unnest(labels.\"{d}\") as u(t)" for d in ("language", "domain", "task", "concept", "agentic", "constraint"))
TAGS = f"""{SAMPLES}, tags0 as ({_SINGLE} union all {_MULTI}), tags as (select row_id, dim, tag,
  greatest(0.0, least(1.0, coalesce(case when isnan(labels.confidence[dim]) then null else labels.confidence[dim] end, 0.75) * case when inherited then 0.65 else 1.0 end)) as confidence
  from tags0 where tag is not null and tag <> '')"""
_ROLE = "case when lower(trim(coalesce(t.\"from\", ''))) in ('user', 'human') then 'human' when lower(trim(coalesce(t.\"from\", ''))) in ('assistant', 'gpt') then 'gpt' else lower(trim(coalesce(t.\"from\", ''))) end"
TURNS = f"""turns as (select s.row_id, s.id, s.metadata.source_file as source_file, g.i as pos, {_ROLE} as role, coalesce(t.value, '') as value, len(s.conversations) as n
  from smoke_test s, unnest(range(1, len(s.conversations) + 1)) as g(i), lateral (select s.conversations[g.i] as t) where len(s.conversations) > 0)"""
