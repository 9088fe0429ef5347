"""From scored slices to one record per conversation. Groups are conversations, each aggregated by expressions with map-side combine where the order of slices doesn't matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import FLAG_BASE, INHERITED_SLICE_WEIGHT, RARITY_MIX, TURN_SIGNAL
from siltworks.operators.value import clamp, shrink


def conversation_key(uid: Column, source_file: Column, source_id: Column) -> Column:
    """The uid if there is one, else file and source id, else the source id."""
    return F.coalesce(F.nullif(uid, F.lit("")), F.when(source_file.isNotNull() & (source_file != ""), F.concat_ws("::", source_file, source_id)), source_id)


def weights(df: DataFrame, key: str, order: list[str], inherited: str = "inherited") -> DataFrame:
    """Adds pos, n and weight: 1 rising to 2 with the place among the slices, times 0.7 where inherited; a single slice has 1."""
    w = Window.partitionBy(key)
    out = df.withColumn("pos", F.row_number().over(w.orderBy(*order))).withColumn("n", F.count("*").over(w))
    base = F.when(F.col("n") > 1, 1 + (F.col("pos") - 1) / (F.col("n") - 1)).otherwise(1.0)
    return out.withColumn("raw_weight", base).withColumn("weight", base * F.when(F.coalesce(inherited, F.lit(False)), INHERITED_SLICE_WEIGHT).otherwise(1.0))


def wavg(value: Column, weight: Column) -> Column:
    """Weighted mean over non-null values."""
    return F.sum(value * weight) / F.sum(F.when(value.isNotNull(), weight))


def penalty(floor: Column, n_flags: Column) -> Column:
    q = F.when(floor < 3, 0.5).when(floor < 5, 0.8).otherwise(1.0)
    return q * F.pow(F.lit(FLAG_BASE), n_flags)


def quality_floor(qualities: Column, agentic: Column) -> Column:
    """The lowest quality; of agentic conversations with at least five the one at a tenth of the order."""
    s = F.array_sort(qualities)
    return F.when(agentic & (F.size(s) >= 5), F.try_element_at(s, F.floor(F.size(s) * 0.1).cast("int") + 1)).otherwise(F.array_min(s))


def conversation_values(weighted: DataFrame, key: str) -> DataFrame:
    """``(key, turns, q_base, floor, penalty, confidence, conv_value)`` of conversations with at least two slices.

    ``weighted`` (see :func:`weights`) has value, quality, confidence, agentic (boolean) and n_flags per slice. Conversations
    without any value are left out."""
    g = weighted.groupBy(key).agg(
        F.count("*").alias("turns"), wavg(F.col("value"), F.col("weight")).alias("wavg"), F.max("value").alias("mx"), F.collect_list("quality").alias("qs"),
        F.coalesce(F.max("agentic"), F.lit(False)).alias("agentic"), F.max("n_flags").alias("flags"), wavg(F.coalesce("confidence", F.lit(1.0)), F.col("weight")).alias("confidence"),
    ).where("turns >= 2 and wavg is not null")
    g = g.withColumn("q_base", 0.7 * F.col("wavg") + 0.3 * F.col("mx")).withColumn("floor", quality_floor(F.col("qs"), F.col("agentic")))
    g = g.withColumn("penalty", penalty(F.col("floor"), F.coalesce("flags", F.lit(0))))
    return g.select(key, "turns", "q_base", "floor", "penalty", "confidence", clamp(shrink(F.col("q_base") * F.col("penalty"), F.col("confidence"))).alias("conv_value"))


def conversation_rarity(weighted: DataFrame, key: str) -> DataFrame:
    """``(key, rarity_mean, rarity_peak, signatures, coverage, conv_rarity)``: mean, peak and label diversity, shrunk where most slices inherit their labels."""
    own = ~F.coalesce("inherited", F.lit(False))
    g = weighted.groupBy(key).agg(
        F.count("*").alias("turns"), wavg(F.col("rarity"), F.col("weight")).alias("rarity_mean"), F.max(F.when(own, F.col("rarity"))).alias("p"), F.max("rarity").alias("p2"),
        F.countDistinct(F.when(own, F.col("signature"))).alias("signatures"), (F.sum(F.when(own, F.col("raw_weight")).otherwise(0.0)) / F.sum("raw_weight")).alias("observed"), wavg(F.coalesce("confidence", F.lit(1.0)), F.col("weight")).alias("confidence"),
    ).where("rarity_mean is not null").withColumn("rarity_peak", F.coalesce("p", "p2"))
    floor = RARITY_MIX["coverage_floor"]
    g = g.withColumn("coverage", F.least(F.lit(1.0), floor + (1 - floor) * F.col("observed")))
    diversity = clamp((F.col("signatures") - 1) / F.greatest(F.col("turns") - 1, F.lit(1)), 0.0, 1.0)
    raw = RARITY_MIX["mean"] * F.col("rarity_mean") + RARITY_MIX["peak"] * F.col("rarity_peak") + RARITY_MIX["diversity"] * diversity
    conf = F.least(F.lit(1.0), 0.5 * F.col("coverage") + 0.5 * clamp(F.col("confidence"), 0.0, 1.0))
    return g.select(key, "rarity_mean", "rarity_peak", "signatures", "coverage", clamp(shrink(F.least(F.lit(10.0), raw), conf)).alias("conv_rarity"))


def turn_metrics(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """``(key, turns, mean, lo, hi, median, std, top_mean, bottom_mean, peak_minus_mean, late_gain)`` of each conversation's values (nulls left out), std of the population."""
    k, b = TURN_SIGNAL["top"], TURN_SIGNAL["bottom"]
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(key, F.struct(*order, F.col(value).alias("v")).alias("s"), F.col(value).alias("v"))
    g = rows.groupBy(key).agg(F.count("*").alias("turns"), F.avg("v").alias("mean"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_pop("v").alias("std"), F.array_sort(F.collect_list("v")).alias("vs"), F.transform(F.array_sort(F.collect_list("s")), lambda x: x["v"]).alias("seq"))
    n = F.size("vs")
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)
    median = (F.element_at("vs", F.floor((n + 1) / 2).cast("int")) + F.element_at("vs", F.floor(n / 2).cast("int") + 1)) / 2
    edge = F.least(F.lit(5), F.greatest(F.lit(1), F.floor(n / 4).cast("int")))
    return g.select(
        key, "turns", "mean", "lo", "hi", median.alias("median"), "std", mean(F.slice("vs", F.greatest(n - k + 1, F.lit(1)), F.lit(k))).alias("top_mean"), mean(F.slice("vs", 1, b)).alias("bottom_mean"),
        (F.col("hi") - F.col("mean")).alias("peak_minus_mean"), (mean(F.slice("seq", n - edge + 1, edge)) - mean(F.slice("seq", F.lit(1), edge))).alias("late_gain"),
    )


def turn_signal(top: Column, median: Column, bottom: Column, low_ratio: Column) -> Column:
    """0.7 top-5 + 0.2 median + 0.1 bottom-3, less where many turns are of low quality."""
    s = TURN_SIGNAL["w_top"] * top + TURN_SIGNAL["w_median"] * median + TURN_SIGNAL["w_bottom"] * bottom
    return s * F.when(low_ratio <= 0.15, 1.0).when(low_ratio <= 0.30, 0.95).otherwise(0.90)


def thinking_summary(df: DataFrame, key: str, mode: str) -> DataFrame:
    """``(key, summary)``: all_fast, all_slow, mixed or unknown."""
    g = df.groupBy(key).agg(F.count_if(F.col(mode) == "slow").alias("s"), F.count_if(F.col(mode) == "fast").alias("f"))
    return g.select(key, F.when((F.col("s") > 0) & (F.col("f") > 0), "mixed").when(F.col("s") > 0, "all_slow").when(F.col("f") > 0, "all_fast").otherwise("unknown").alias("summary"))


def merge_labels(df: DataFrame, key: str, order: list[str], single: list[str], multi: list[str]) -> DataFrame:
    """Per conversation the last non-empty single labels, and lists joined in order without repeats."""
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.struct(*order))).alias(c) for c in single]
    aggs += [F.array_sort(F.collect_list(F.struct(*order, F.col(c).alias("x")))).alias(c) for c in multi]
    return df.groupBy(key).agg(*aggs).select(key, *single, *[F.array_distinct(F.flatten(F.transform(c, lambda s: F.coalesce(s["x"], F.array().cast("array<string>"))))).alias(c) for c in multi])


def guardrail(candidate: Column, baseline: Column, up: float, down: float = 0.5) -> Column:
    return F.greatest(baseline - down, F.least(baseline + up, candidate))


def structure_score(high_ratio: Column, low_ratio: Column, late_gain: Column, peak: Column, edit_ratio: Column, test_ratio: Column, file_ratio: Column, tools: Column, tool_ratio: Column, final: Column, resolved: Column) -> Column:
    """Progress, recovery, tool use, resolution and non-redundancy of a trajectory, each 1..10, weighted .25 .20 .20 .20 .15."""
    u = lambda c: clamp(c, 0.0, 1.0)
    late, comp = u(late_gain / 2.5), u(peak / 2.5)
    over = u((tool_ratio - 0.70) / 0.30)
    ev = F.least(F.lit(1.0), 0.45 * edit_ratio + 0.35 * test_ratio + 0.20 * file_ratio)
    progress = u(0.40 * high_ratio + 0.25 * late + 0.20 * edit_ratio + 0.15 * comp)
    recovery = F.when(low_ratio <= 0.10, u(0.65 + 0.20 * test_ratio + 0.15 * edit_ratio)).otherwise(u(0.35 * late + 0.35 * test_ratio + 0.30 * edit_ratio))
    tool = F.when(tools <= 0, u(0.45 + 0.35 * ev + 0.20 * (1 - over))).otherwise(u(0.45 * F.least(F.lit(1.0), tools / 3) + 0.30 * ev + 0.25 * (1 - over)))
    done = u(0.45 * u(final / 10) + 0.25 * ev + 0.15 * late + 0.15 * resolved)
    fresh = u(0.45 * high_ratio + 0.35 * (1 - low_ratio) + 0.20 * (1 - over))
    return 0.25 * (1 + 9 * progress) + 0.20 * (1 + 9 * recovery) + 0.20 * (1 + 9 * tool) + 0.20 * (1 + 9 * done) + 0.15 * (1 + 9 * fresh)
