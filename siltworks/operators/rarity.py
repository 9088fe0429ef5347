"""How rare a record's labels are: inverse frequencies by tag, dimension and combination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import COMBO_ALPHA, EXTENSION, RARITY_WEIGHTS


def distribution(long: DataFrame) -> DataFrame:
    """``(dim, tag, n)``: uses of every tag, repeats within a record counted."""
    return long.groupBy("dim", "tag").agg(F.count("*").alias("n"))


def idf(n: Column, total: Column | int) -> Column:
    """max(0, log2(N / (n + 1)))."""
    total = F.lit(total) if isinstance(total, int) else total
    return F.greatest(F.lit(0.0), F.log2(total / (n + 1)))


def idf_table(dist: DataFrame, total: int) -> DataFrame:
    """``(dim, tag, n, idf, prior)``: the prior is the dimension's mean idf."""
    w = dist.withColumn("idf", idf(F.col("n"), total))
    return w.join(F.broadcast(w.groupBy("dim").agg(F.avg("idf").alias("prior"))), "dim")  # one row a dimension


def _weights() -> Column:
    return F.create_map(*[F.lit(x) for kv in RARITY_WEIGHTS.items() for x in kv])


def sample_rarity(long: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``(key, tag_rarity, confidence)``: the weighted mean over a record's dimensions of 0.6 max + 0.4 mean of its tags'
    idf, shrunk to the dimension's prior by the label confidence. A tag that the baseline lacks counts as the prior; a
    dimension that it lacks is left out."""
    priors = table.select("dim", "prior").distinct()
    j = long.join(F.broadcast(priors), "dim").join(table.select("dim", "tag", "idf"), ["dim", "tag"], "left").withColumn("v", F.coalesce("idf", "prior"))
    per = j.groupBy(key, "dim").agg(F.max("v").alias("mx"), F.avg("v").alias("mn"), F.max("prior").alias("prior"), F.max("confidence").alias("c"))
    obs = 0.6 * F.col("mx") + 0.4 * F.col("mn")
    per = per.withColumn("r", F.col("c") * obs + (1 - F.col("c")) * F.col("prior")).withColumn("w", _weights()[F.col("dim")])
    return per.groupBy(key).agg((F.sum(F.col("w") * F.col("r")) / F.sum("w")).alias("tag_rarity"), F.avg("c").alias("confidence"))


def combo_rarity(combo_n: Column, total: int, confidence: Column, tag_rarity: Column) -> Column:
    """Not clamped at 0; 0 for a combination that the baseline lacks."""
    own = confidence * F.log2(F.lit(total) / (combo_n + 1)) + (1 - confidence) * tag_rarity
    return F.when(combo_n.isNull(), 0.0).otherwise(own)


def combo_baseline(external: DataFrame | None, local: DataFrame | None) -> tuple[DataFrame | None, str]:
    """Which combination counts rarity is measured by: the external ones if there are any, else the batch's own (hybrid), else none (disabled)."""
    for counts, name in ((external, "external"), (local, "hybrid")):
        if counts is not None and not counts.isEmpty():
            return counts, name
    return None, "disabled"


def raw_rarity(tag: Column, combo: Column, alpha: float = COMBO_ALPHA) -> Column:
    return alpha * tag + (1 - alpha) * combo


def absolute(raw: Column, total: int) -> Column:
    """1..10 against the largest possible idf, independent of the batch."""
    top = F.log2(F.greatest(F.lit(total), F.lit(2)))
    return 1 + 9 * F.greatest(F.lit(0.0), F.least(raw, top)) / top


def percentile_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Adds 1 + 9 * (lowest rank of ties) / (n - 1): by counts of the distinct values, so no task sorts all rows."""
    return _by_value(df, value, lambda below, ties, n: 1 + 9 * below / F.greatest(n - 1, F.lit(1)), out, [])


def mid_rank(df: DataFrame, value: str, by: list[str], out: str = "pct") -> DataFrame:
    """Adds ((first + last) / 2) / (n - 1) of the ascending order within ``by``, ties sharing the middle; 1 row gives 0."""
    return _by_value(df, value, lambda below, ties, n: (below + (ties - 1) / 2) / F.greatest(n - 1, F.lit(1)), out, by)


def _by_value(df: DataFrame, value: str, formula, out: str, by: list[str]) -> DataFrame:  # noqa: ANN001
    """A rank from the counts of each distinct value: running totals over ranges of values, then over the ranges."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_t"))
    if by:
        w = Window.partitionBy(*by).orderBy(value)
        ranked = counts.withColumn("_b", F.coalesce(F.sum("_t").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_n", F.sum("_t").over(Window.partitionBy(*by)))
    else:
        parts = counts.repartitionByRange(value).withColumn("_p", F.spark_partition_id())
        totals = parts.groupBy("_p").agg(F.sum("_t").alias("_s"))
        before = totals.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_s").over(Window.partitionBy(F.lit(1))).alias("_n"))  # one row a range
        inner = F.coalesce(F.sum("_t").over(Window.partitionBy("_p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranked = parts.join(F.broadcast(before), "_p").withColumn("_b", F.col("_before") + inner).drop("_p", "_before")
    keyed = ranked.select(*by, value, formula(F.col("_b"), F.col("_t"), F.col("_n")).alias(out))
    return df.join(keyed, [*by, value], "left")


def extension_bonus(ext: Column, confidence: Column, support: Column) -> Column:
    """min(0.5, 0.1 * gate * max(0, ext - 5)); the gate is the confidence where the baseline has enough support, else 0."""
    gate = F.when(support >= EXTENSION["min_baseline"], confidence).otherwise(0.0)
    return F.least(F.lit(EXTENSION["bonus_cap"]), EXTENSION["bonus_rate"] * gate * F.greatest(F.lit(0.0), ext - 5))
