"""Statistics: order statistics, histograms, keep rates, roll-ups. Order statistics come from counts of distinct values, so they are exact and no task sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import KEEP_THRESHOLDS


def order_statistics(df: DataFrame, value: str, pcts: Sequence[int], by: Sequence[str] = (), nearest: bool = False) -> DataFrame:
    """``(by..., pct, value)``: the element at int(n*p/100) of the ascending order, n-1 at most; with ``nearest`` at
    round((n-1)*p/100), half to even. Nulls and NaN are left out."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("_t"))
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy(value)  # one row a distinct value
    run = counts.withColumn("_hi", F.sum("_t").over(w)).withColumn("_n", F.sum("_t").over(Window.partitionBy(*(by or [F.lit(1)]))))
    p = run.withColumn("pct", F.explode(F.array(*[F.lit(x) for x in pcts])))
    at = F.bround((F.col("_n") - 1) * F.col("pct") / 100, 0) if nearest else F.least(F.floor(F.col("_n") * F.col("pct") / 100), F.col("_n") - 1)
    hit = p.where((at < F.col("_hi")) & (at >= F.col("_hi") - F.col("_t")))
    return hit.select(*by, F.col("pct").cast("long").alias("pct"), F.col(value).alias("value"))


def histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ten bins: 1 up to below 2, and so on; 10 and more in the last, below 1 in the first."""
    b = F.greatest(F.lit(1), F.least(F.lit(10), F.floor(value))).cast("long")
    return df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"))


def keep_rates(df: DataFrame, value: str, by: Sequence[str] = (), thresholds: Sequence[float] = KEEP_THRESHOLDS) -> DataFrame:
    """Share of rows at or over each threshold, of those with a value."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg((F.col(value) >= t).cast("double")).alias(f"keep_{int(t)}") for t in thresholds])


def numeric_summary(value: str | Column) -> list[Column]:
    c = F.col(value) if isinstance(value, str) else value
    ok = F.when(~F.isnan(c), c)
    return [F.count(ok).alias("n"), F.sum(ok).alias("total"), F.avg(ok).alias("mean"), F.min(ok).alias("lo"), F.max(ok).alias("hi")]


def scope_rollup(df: DataFrame, path: str, aggs: list[Column]) -> DataFrame:
    """``(scope, depth, aggs...)`` of every folder prefix of a path and of all rows (scope '')."""
    parts = F.split(F.coalesce(F.col(path), F.lit("")), "/")
    scopes = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, 1, i), "/").alias("scope"), i.alias("depth")))
    return df.withColumn("_s", F.explode(scopes)).groupBy(F.col("_s.scope").alias("scope"), F.col("_s.depth").cast("long").alias("depth")).agg(*aggs)


def coverage_at(long: DataFrame, scored: DataFrame, key: str, value: str, thresholds: Sequence[float]) -> DataFrame:
    """``(threshold, tags, retained, coverage)``: how many distinct tags keep a record at each threshold."""
    best = long.join(scored.select(key, value), key).where(~F.isnan(value)).groupBy("dim", "tag").agg(F.max(value).alias("m"))
    every = long.select("dim", "tag").distinct().agg(F.count("*").alias("tags"))
    kept = best.select(F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"), "m").groupBy("threshold").agg(F.count_if(F.col("m") >= F.col("threshold")).alias("retained"))
    return kept.crossJoin(F.broadcast(every)).select("threshold", "tags", "retained", (F.col("retained") / F.col("tags")).alias("coverage"))  # one row each side of a handful


def merge_counts(parts: Sequence[DataFrame], keys: Sequence[str], n: str = "n") -> DataFrame:
    """Counts of several inputs added up."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*keys).agg(F.sum(n).alias(n))


def merge_summaries(parts: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Numeric summaries (n, total, lo, hi) of several inputs as one; the mean is exact, not a mean of means."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    g = out.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return g.withColumn("mean", F.col("total") / F.col("n"))


def percentiles_from_bins(bins: DataFrame, pcts: Sequence[int]) -> DataFrame:
    """``(pct, value)`` estimated from a histogram (bin, n): the place within the bin that holds the wanted rank, linearly."""
    w = Window.orderBy("bin")  # ten rows
    run = bins.withColumn("_hi", F.sum("n").over(w)).withColumn("_n", F.sum("n").over(Window.partitionBy(F.lit(1))))
    p = run.withColumn("pct", F.explode(F.array(*[F.lit(x) for x in pcts])))
    want = F.col("_n") * F.col("pct") / 100
    hit = p.where((want <= F.col("_hi")) & ((want > F.col("_hi") - F.col("n")) | ((F.col("pct") == 0) & (F.col("_hi") == F.col("n")))))
    return hit.select(F.col("pct").cast("long").alias("pct"), (F.col("bin") + (want - (F.col("_hi") - F.col("n"))) / F.col("n")).alias("value"))
