"""Labels and scores kept inside their raw rows: read out, folded back, replaced turn by turn, invalidated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "struct<turn_index:int,labels:map<string,array<string>>,inherited:boolean,inherited_from:int,value_score:double>"


def embedded(df: DataFrame, key: str, turns: str = "label_turns", require_labels: bool = False, require_value: bool = False) -> DataFrame:
    """One row per embedded turn record: ``(key, turn_index, labels, inherited, inherited_from, value_score)``."""
    out = df.select(key, F.explode(turns).alias("t")).select(key, "t.*")
    if require_labels:
        out = out.where(F.size("labels") > 0)
    return out.where("value_score is not null") if require_value else out


def fold(df: DataFrame, records: DataFrame, key: str, turns: str = "label_turns") -> DataFrame:
    """Records replace or join the embedded ones of their row by turn_index, of several for one turn the last embedded and
    the one with the largest fields among ``records``; rows without records stay."""
    fields = ["turn_index", "labels", "inherited", "inherited_from", "value_score"]
    new = records.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("turn_index")))).alias("_i"), F.collect_list(F.struct(*fields)).alias("_n"))  # one row's turns
    out = df.join(new, key, "left")
    at = F.coalesce(F.transform("_i", lambda x: x["turn_index"]), F.array().cast("array<int>"))
    old = F.filter(F.coalesce(turns, F.array().cast(f"array<{LABEL}>")), lambda t: ~F.array_contains(at, t["turn_index"]))
    both = F.concat(old.cast(f"array<{LABEL}>"), F.coalesce(F.col("_n").cast(f"array<{LABEL}>"), F.array().cast(f"array<{LABEL}>")))
    last = F.aggregate(both, F.array().cast(f"array<{LABEL}>"), lambda acc, t: F.concat(F.filter(acc, lambda x: x["turn_index"] != t["turn_index"]), F.array(t)))
    return out.withColumn(turns, F.array_sort(last, lambda x, y: F.when(x["turn_index"] < y["turn_index"], -1).when(x["turn_index"] > y["turn_index"], 1).otherwise(0))).drop("_i", "_n")


def without_scores(turns: Column) -> Column:
    """Turn records with their downstream fields cleared, as after a relabeling."""
    return F.transform(turns, lambda t: t.withField("value_score", F.lit(None).cast("double")))


def inherit(slices: DataFrame, key: str, pos: str, source: str, labels: list[str]) -> DataFrame:
    """Slices without labels take those of their source slice; added: inherited and inherited_from."""
    src = slices.where(F.col(source).isNull()).select(F.col(key).alias("_k"), F.col(pos).alias("_p"), *[F.col(c).alias(f"_{c}") for c in labels])
    j = slices.join(src, (F.col(key) == F.col("_k")) & (F.col(source) == F.col("_p")), "left")
    out = [F.when(F.col(source).isNull(), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in labels]
    return j.select(*[c for c in slices.columns if c not in labels], *out, F.col("_p").isNotNull().alias("inherited"), F.col("_p").alias("inherited_from"))


def plan_mode(has_label: Column, same_version: Column, mode: str) -> Column:
    """What a run does with a row: refresh labels all, incremental those without a current label, migrate those without any."""
    if mode == "refresh":
        return F.lit("label")
    if mode == "migrate":
        return F.when(has_label, "copy").otherwise("label")
    return F.when(has_label & same_version, "keep").otherwise("label")


def workload(slices: DataFrame, by: str, labelled: Column, scored: Column) -> DataFrame:
    """``(by, slices, labelled, inherited, to_score)``: what a run will cost."""
    return slices.groupBy(by).agg(F.count("*").alias("slices"), F.count_if(labelled).alias("labelled"), F.count_if(~labelled).alias("inherited"), F.count_if(~scored).alias("to_score"))
