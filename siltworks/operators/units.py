"""Conversations as units of statistics: merged confidences, unmapped tags and extension labels, records of single turns, second scores with extensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.config import EXTENSION, MULTI_DIMS, SINGLE_DIMS
from siltworks.operators.conversation import wavg
from siltworks.operators.labels import as_arrays, clean_confidence
from siltworks.operators.value import clamp, compose_selection, value_score


def dimension_confidence(df: DataFrame, key: str, order: Sequence[str], labels: str = "labels", inherited: str = "inherited") -> DataFrame:
    """``(key, dim, confidence)``: of single-valued dimensions the last confidence; of lists the mean over slices with own
    tags, or, where there are none, over those that inherit theirs; lists without tags don't count."""
    lab, conf = F.col(labels), clean_confidence(F.col(f"{labels}.confidence"))
    entry = lambda d, some: F.struct(F.lit(d).alias("dim"), F.try_element_at(conf, F.lit(d)).alias("c"), some.alias("some"))
    dims = [entry(d, F.lit(True)) for d in SINGLE_DIMS] + [entry(d, F.size(as_arrays(lab, (d,))[d]) > 0) for d in MULTI_DIMS]
    rows = df.where(lab.isNotNull()).select(key, F.struct(*order).alias("o"), F.coalesce(inherited, F.lit(False)).alias("i"), F.explode(F.array(*dims)).alias("e")).where("e.c is not null and e.some")
    g = rows.groupBy(key, F.col("e.dim").alias("dim")).agg(F.max_by("e.c", "o").alias("last"), F.avg(F.when(~F.col("i"), F.col("e.c"))).alias("own"), F.avg(F.when(F.col("i"), F.col("e.c"))).alias("other"))
    return g.select(key, "dim", F.when(F.col("dim").isin(*SINGLE_DIMS), F.col("last")).otherwise(F.coalesce("own", "other")).alias("confidence"))


def merged_unmapped(df: DataFrame, key: str, order: Sequence[str], unmapped: str = "labels.unmapped") -> DataFrame:
    """``(key, dimension, value, first)``: each unmapped tag of a conversation once, with the slice that had it first."""
    u = df.select(key, F.struct(*order).alias("first"), F.explode(unmapped).alias("u"))
    return u.groupBy(key, F.coalesce("u.dimension", F.lit("unknown")).alias("dimension"), F.coalesce("u.value", F.lit("?")).alias("value")).agg(F.min("first").alias("first"))


def label_sources(df: DataFrame, key: str, labels: str = "labels", inherited: str = "inherited", partial: str = "partial") -> DataFrame:
    """``(key, slices, observed, inherited)``: slices with usable labels of their own, and with inherited ones."""
    usable = F.col(labels).isNotNull() & ~F.coalesce(partial, F.lit(False))
    inh = F.coalesce(inherited, F.lit(False))
    return df.groupBy(key).agg(F.count("*").alias("slices"), F.count_if(usable & ~inh).alias("observed"), F.count_if(usable & inh).alias("inherited"))


def merged_extensions(long: DataFrame, key: str, order: Sequence[str], single: Sequence[str] = ()) -> DataFrame:
    """``(key, spec, field, values, confidence)`` of a conversation from long rows (key, order, spec, field, value,
    confidence): fields in ``single`` keep the last value, others all in order without repeats; confidences are averaged."""
    g = long.where("value is not null and value <> ''").groupBy(key, "spec", "field", "value").agg(F.min(F.struct(*order)).alias("at"), F.max(F.struct(*order)).alias("last"), F.sum("confidence").alias("s"), F.count("confidence").alias("c"))
    g = g.groupBy(key, "spec", "field").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("v"), F.max_by("value", "last").alias("l"), (F.sum("s") / F.sum("c")).alias("confidence"))
    values = F.transform("v", lambda x: x["value"])
    return g.select(key, "spec", "field", (F.when(F.col("field").isin(*single), F.array("l")).otherwise(values) if single else values).alias("values"), "confidence")


def extension_statistics(units: DataFrame) -> DataFrame:
    """``(spec, field, value, units, confidence)`` of merged units (spec, field, values, confidence)."""
    e = units.select("spec", "field", "confidence", F.explode("values").alias("value"))
    return e.groupBy("spec", "field", "value").agg(F.count("*").alias("units"), F.avg("confidence").alias("confidence"))


def extended_rarity(core: Column, extension: Column, confidence: Column, support: Column, external: Column | bool = True) -> Column:
    """Struct (score, bonus, gate): the core rarity plus a bonus for rare extension labels, within 1..10. The gate is the
    confidence where the baseline is external and has enough support, else 0; a missing core stays missing."""
    ok = (support >= EXTENSION["min_baseline"]) & (F.lit(external) if isinstance(external, bool) else external)
    gate = F.when(F.coalesce(ok, F.lit(False)) & extension.isNotNull(), clamp(F.coalesce(confidence, F.lit(0.0)), 0.0, 1.0)).otherwise(0.0)
    bonus = F.least(F.lit(EXTENSION["bonus_cap"]), EXTENSION["bonus_rate"] * gate * F.greatest(F.lit(0.0), F.coalesce(extension, F.lit(5.0)) - 5))
    return F.struct(F.when(core.isNotNull(), clamp(core + bonus)).alias("score"), bonus.alias("bonus"), gate.alias("gate"))


def second_scores(complexity: Column, quality: Column, reasoning: Column, rarity2: Column, confidence: Column, intra: Column, pure: Column, multiplier: Column | float = 1.0) -> Column:
    """Struct (value, selection) with the extended rarity in the place of the core one."""
    m = F.lit(multiplier) if isinstance(multiplier, float) else multiplier
    value = clamp(value_score(complexity, quality, reasoning, rarity2, confidence) * m)
    return F.struct(value.alias("value"), compose_selection(intra, pure, rarity2, m).alias("selection"))


def conversation_extension_rarity(weighted: DataFrame, key: str, core: str, extended: str, conv_rarity: str, confidence: str = "confidence") -> DataFrame:
    """``(key, conv_rarity_extension)``: a conversation's rarity plus 0.7 mean and 0.3 peak of its slices' bonuses, times its
    confidence; without any slice with both scores its rarity as it is; null where no slice has an extended score."""
    bonus = F.when(F.col(extended).isNotNull() & F.col(core).isNotNull(), F.greatest(F.lit(0.0), F.col(extended) - F.col(core)))
    g = weighted.groupBy(key).agg(F.count(extended).alias("seen"), wavg(bonus, F.col("weight")).alias("mean"), F.max(bonus).alias("peak"), F.first(conv_rarity, ignorenulls=True).alias("base"), wavg(F.coalesce(F.col(confidence), F.lit(1.0)), F.col("weight")).alias("c"))
    add = (0.7 * F.col("mean") + 0.3 * F.col("peak")) * clamp(F.col("c"), 0.0, 1.0)
    out = F.when(F.col("seen") == 0, None).when(F.col("mean").isNull(), F.col("base")).otherwise(clamp(F.coalesce("base", F.lit(0.0)) + add))
    return g.select(key, out.alias("conv_rarity_extension"))


def single_turn_records(df: DataFrame) -> DataFrame:
    """Conversation records of slices that stand alone: (source_id, id, row_id, source_file, conversation_uid, value,
    selection, rarity, confidence, inherited) become records of one turn, with the scores as they are."""
    cid = F.coalesce(F.nullif("source_id", F.lit("")), F.concat_ws("::row:", "id", F.col("row_id").cast("string")))
    key = F.coalesce(F.nullif("conversation_uid", F.lit("")), F.when(F.coalesce("source_file", F.lit("")) != "", F.concat_ws("::", "source_file", cid)), cid)
    own = F.when(F.coalesce("inherited", F.lit(False)), 0.0).otherwise(1.0)
    return df.select(
        cid.alias("conversation_id"), F.coalesce(F.nullif("conversation_uid", F.lit("")), key).alias("conversation_uid"), key.alias("conversation_key"), "source_file", F.lit(1).cast("long").alias("turn_count"), F.col("value").alias("conv_value"), F.col("selection").alias("conv_selection"),
        F.col("rarity").alias("conv_rarity"), own.alias("observed_turn_ratio"), (1 - own).alias("inherited_turn_ratio"), F.col("confidence").alias("rarity_confidence"),
    )


def merge_records(parts: Sequence[DataFrame], key: str = "conversation_key", by: str = "turn_count") -> DataFrame:
    """Conversation records of several runs as one set: of one key the record with more turns counts."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    rest = [c for c in out.columns if c != key]
    return out.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(by, *[c for c in rest if c != by])).alias("_r")).select(key, "_r.*")
