"""Value and selection scores of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import EVIDENCE, LOW_INFO, NO_EVIDENCE, QUALITY_FLOOR, QUALITY_FLOOR_FACTOR, RARITY_DEFAULT, RARITY_WEIGHTS, SCORE_ANCHOR, SELECTION, SELECTIVE, STAGE_SELECTION, STAGE_VALUE, VALUE_WEIGHTS
from siltworks.operators.rarity import mid_rank
from siltworks.session import written

SALTS = 8  # parts of a tag's records with one value


def clamp(c: Column, lo: float = 1.0, hi: float = 10.0) -> Column:
    """``c`` within lo..hi; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def shrink(v: Column, confidence: Column) -> Column:
    """Values above 5.5 move towards it as confidence falls; others stay. A missing confidence is 1."""
    c = clamp(F.coalesce(confidence, F.lit(1.0)), 0.0, 1.0)
    return F.when(v <= SCORE_ANCHOR, v).otherwise(SCORE_ANCHOR + c * (v - SCORE_ANCHOR))


def _weighted(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    num = sum((F.when(c.isNotNull(), c * weights[k]).otherwise(0.0) for k, c in parts.items()), F.lit(0.0))
    den = sum((F.when(c.isNotNull(), F.lit(weights[k])).otherwise(0.0) for k, c in parts.items()), F.lit(0.0))
    return F.when(den > 0, num / den)


def value_score(complexity: Column, quality: Column, reasoning: Column, rarity: Column, confidence: Column, weights: dict[str, float] | None = None) -> Column:
    """Weighted mean of the parts present, times 0.7 where quality is below 4, shrunk by confidence, within 1..10; null with fewer than two of complexity, quality and reasoning."""
    w = weights or VALUE_WEIGHTS
    base = _weighted({"complexity": complexity, "quality": quality, "reasoning": reasoning, "rarity": F.coalesce(rarity, F.lit(RARITY_DEFAULT))}, w)
    base = F.when(quality < QUALITY_FLOOR, base * QUALITY_FLOOR_FACTOR).otherwise(base)
    n = sum((c.isNotNull().cast("int") for c in (complexity, quality, reasoning)), F.lit(0))
    return F.when(n >= 2, clamp(shrink(base, confidence)))


def pure_quality(complexity: Column, quality: Column, reasoning: Column) -> Column:
    """The same without rarity, shrinkage and rounding; null without any part."""
    base = _weighted({"complexity": complexity, "quality": quality, "reasoning": reasoning}, VALUE_WEIGHTS)
    return F.when(quality < QUALITY_FLOOR, base * QUALITY_FLOOR_FACTOR).otherwise(base)


def stage(position: Column, has_trajectory: Column, tool_density: Column, evidence: Column, low_info: Column, summary_hits: Column, verification_hits: Column) -> Column:
    """Where in its conversation a slice works."""
    return (
        F.when((summary_hits > 0) & (position >= 0.7), "final-summary").when((position <= 0.18) & ~has_trajectory & ~evidence, "opener")
        .when(low_info | ((tool_density >= 0.6) & ~evidence), "exploration").when((verification_hits > 0) & (position >= 0.5), "verification").otherwise("implementation")
    )


def stage_multiplier(st: Column, low_info: Column, evidence: Column, for_selection: bool) -> Column:
    table = STAGE_SELECTION if for_selection else STAGE_VALUE
    base = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[st]
    base = F.when(low_info, base * LOW_INFO).otherwise(base)
    bonus = F.lit(EVIDENCE if for_selection else 1.0)
    base = F.when(st == "final-summary", base * F.when(evidence, bonus).otherwise(NO_EVIDENCE)).otherwise(base)
    return clamp(base, 0.5, 1.1)


def stable_value(value: Column, multiplier: Column) -> Column:
    """A value score times its stage's multiplier, within 1..10; null stays null."""
    return clamp(value * multiplier)


def anchors_distance(turn: Column, total: Column, drift: int = SELECTIVE["drift"]) -> Column:
    """Turns to the nearest anchor: the first, the last, and every ``drift``-th from the first."""
    back = (turn - 1) % drift
    ahead = F.when(turn + drift - back <= total, drift - back).otherwise(total)
    return F.least(back, ahead, F.abs(total - turn))


def selective_reason(source: Column, turn: Column, total: Column, inherited: Column, min_turns: int = SELECTIVE["min_turns"], drift: int = SELECTIVE["drift"]) -> Column:
    """Why a slice needs the scorer, or that it is estimated."""
    return (
        F.when(source.isNull() | (source == "") | F.coalesce(total <= 1, F.lit(True)) | F.coalesce(turn <= 0, F.lit(True)), "missing_multiturn_metadata").when(total < min_turns, "below_min_turns_threshold")
        .when(~F.coalesce(inherited, F.lit(False)), "non_inherited_turn").when(anchors_distance(turn, total, drift) == 0, "required_anchor_turn").otherwise("inherited_mid_turn_estimate")
    )


def estimate(prior: Column, inherited: Column, distance: Column) -> Column:
    """Pseudo scores of slices that get no scorer call."""
    cx = prior - F.least(0.15 * distance, F.lit(1.0))
    q = 5 - F.when(inherited, 0.8).otherwise(0.0) - F.least(0.3 * distance, F.lit(1.2))
    r = cx - 0.6 - F.least(0.12 * distance, F.lit(0.5))
    return F.struct(clamp(cx).alias("complexity"), clamp(q).alias("quality"), clamp(r).alias("reasoning"))


def selection_scores(scored: DataFrame, long: DataFrame, key: str, quality: str = "pure_quality", min_group: int = SELECTION["min_group"], prior: int = SELECTION["prior"]) -> DataFrame:
    """``(key, global_pct, intra_rank)``: percentile of quality among all, and within each tag shrunk to the global one.

    A tag with n of effective size s = sum of confidences pulls with s / (s + prior), for tags of at least ``min_group``
    records; its confidence (0.25 at least) weighs it against the global percentile. Dimensions are averaged by rarity
    weight and confidence. Records without usable tags keep the global percentile. Ranks come from counts of distinct
    values, so a tag that most records have doesn't gather in one task. Scores are 1 + 9x."""
    base = mid_rank(scored.where(F.col(quality).isNotNull()).select(key, F.round(quality, 4).alias("q")), "q", [], "g")
    base = written(base, "ranked")
    tags = long.groupBy(key, "dim", "tag").agg(F.greatest(F.max("confidence"), F.lit(SELECTION["confidence_floor"])).alias("c"))
    j = written(tags.join(base, key), "tagged")
    # of each tag and value: its rank within the tag, and the tag's size; a value that most records share is cut into parts
    at = j.groupBy("dim", "tag", "q").agg(F.count("*").alias("k"), F.sum("c").alias("cs"))
    w = Window.partitionBy("dim", "tag")
    below = F.coalesce(F.sum("k").over(w.orderBy("q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = at.select("dim", "tag", "q", "k", below.alias("below"), F.sum("k").over(w).alias("n"), F.sum("cs").over(w).alias("s")).where(F.col("n") >= min_group)
    at = at.select("dim", "tag", "q", "s", ((F.col("below") + (F.col("k") - 1) / 2) / F.greatest(F.col("n") - 1, F.lit(1))).alias("t"), F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("part"))
    j = j.withColumn("part", F.pmod(F.xxhash64(key), F.lit(SALTS))).join(at, ["dim", "tag", "q", "part"])
    pull = F.col("s") / (F.col("s") + prior)
    p = F.col("c") * (pull * F.col("t") + (1 - pull) * F.col("g")) + (1 - F.col("c")) * F.col("g")
    per = j.withColumn("p", p).groupBy(key, "dim").agg(F.avg("p").alias("p"), F.max("c").alias("c"))
    w = F.create_map(*[F.lit(x) for kv in RARITY_WEIGHTS.items() for x in kv])[F.col("dim")] * F.col("c")
    intra = per.groupBy(key).agg((F.sum(w * F.col("p")) / F.sum(w)).alias("i"))
    out = base.join(intra, key, "left")
    return out.select(key, F.col("g").alias("global_pct"), (1 + 9 * F.coalesce("i", "g")).alias("intra_rank"))


def compose_selection(intra: Column, quality: Column, rarity: Column, multiplier: Column | float = 1.0) -> Column:
    """0.49 intra + 0.20 quality + 0.31 rarity, over what is present, times the stage multiplier, within 1..10."""
    m = F.lit(multiplier) if isinstance(multiplier, float) else multiplier
    return clamp(_weighted({"intra": intra, "quality": quality, "rarity": rarity}, SELECTION) * m)
