"""Problem 3: items that stand together on one record, how often, and how much more often than chance.

Exact pair counts: each task counts its records' pairs in bounded chunks (map-side combine), one aggregation by pair adds
them. Chance is a bipartite configuration model fitted to the item frequencies and basket sizes: item i is in basket b with
probability x_i*y_b / (1 + x_i*y_b), so that expected item frequencies and basket sizes are the observed ones. Items of equal
frequency and baskets of equal size share their parameter, so the fit works on classes. The number of baskets that hold both
of two items is then Poisson-binomial; its upper tail is the pair's p-value, and Benjamini-Hochberg gives its q-value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import latest, norm_tag
from siltworks.session import written

FIELDS = ("concept", "domain", "agentic", "constraint")
CHUNK = 300_000
BIN = 100  # bins of -log10 p per unit
P_MIN = 1e-300


def baskets(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``items``: the distinct ``field:tag`` of each record (latest row of each ``id``), sorted; records without tags have none."""
    one = latest(df, [F.col("labels").getField(f).alias(f) for f in fields])
    tags = {f: F.filter(F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), norm_tag), lambda t: t.isNotNull() & (t != "")) for f in fields}
    items = F.flatten(F.array(*[F.transform(t, _item(f)) for f, t in tags.items()]))
    return one.select(F.array_sort(F.array_distinct(items)).alias("items"))


def _item(field: str):  # noqa: ANN202
    return lambda t: F.concat(F.lit(field + ":"), t)


def _pair_counts(kept: frozenset[str] | None = None):  # noqa: ANN202
    """Counts by pair of a task's baskets, of the items ``kept`` (None: all), flushed at CHUNK distinct pairs, within one long basket too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], int] = {}

        def flush() -> pa.RecordBatch:
            keys = list(counts)
            out = pa.RecordBatch.from_pydict({"item_a": pa.array([a for a, _ in keys], pa.string()), "item_b": pa.array([b for _, b in keys], pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for items in batch.column(0).to_pylist():
                items = sorted(items if kept is None else kept.intersection(items))
                for i, a in enumerate(items):
                    for b in items[i + 1 :]:
                        counts[a, b] = counts.get((a, b), 0) + 1
                    if len(counts) >= CHUNK:
                        yield flush()
        if counts:
            yield flush()

    return run


def fit(item_n: np.ndarray, item_m: np.ndarray, size: np.ndarray, size_m: np.ndarray, rounds: int = 2000, tol: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """x of each item class (frequency item_n, item_m items) and y of each basket class (size, size_m baskets)."""
    total = float((item_n * item_m).sum()) or 1.0
    x, y = item_n / np.sqrt(total), size / np.sqrt(total)
    for _ in range(rounds):
        x0 = x
        x = item_n / np.maximum((size_m * y / (1 + np.outer(x, y))).sum(1), 1e-300)
        y = size / np.maximum(((item_m * x)[:, None] / (1 + np.outer(x, y))).sum(0), 1e-300)
        if np.max(np.abs(x / x0 - 1), initial=0) < tol:
            break
    return x, y


def upper_tail(k: np.ndarray, p: np.ndarray, m: np.ndarray) -> np.ndarray:
    """P(X >= k) where X sums m[j] Bernoulli(p[:, j]) over j: by the saddlepoint with lattice correction, one row a case."""
    mean = (p * m).sum(1)
    var = np.maximum((p * (1 - p) * m).sum(1), 1e-300)
    s = np.zeros(len(k))
    kk = np.minimum(k.astype(float), (m * (p > 0)).sum(1) - 1e-9)
    for _ in range(60):  # K'(s) = k by a damped Newton
        q = p * np.exp(np.minimum(s, 50))[:, None]
        q = q / (1 - p + q)
        step = ((q * m).sum(1) - kk) / np.maximum((q * (1 - q) * m).sum(1), 1e-12)
        s = np.clip(s - np.clip(step, -2, 2), -50, 50)
    with np.errstate(all="ignore"):
        kgf = (m * np.log1p(p * np.expm1(s)[:, None])).sum(1)
        q = p * np.exp(s)[:, None]
        q = q / (1 - p + q)
        k2 = np.maximum((q * (1 - q) * m).sum(1), 1e-12)
        w = np.sign(s) * np.sqrt(np.maximum(2 * (s * kk - kgf), 0))
        u = (1 - np.exp(-s)) * np.sqrt(k2)
        tail = _sf(w) + np.exp(-w * w / 2) / np.sqrt(2 * np.pi) * (1 / u - 1 / w)
        plain = _sf((kk - 0.5 - mean) / np.sqrt(var))
    out = np.where((np.abs(w) < 1e-3) | ~np.isfinite(tail), plain, tail)
    out = np.where(k <= 0, 1.0, out)
    return np.clip(out, P_MIN, 1.0)


def _sf(z: np.ndarray) -> np.ndarray:
    from math import erfc

    return np.array([0.5 * erfc(v / np.sqrt(2)) if np.isfinite(v) else 0.0 for v in z])


def co_occurrence(df: DataFrame, min_count: int = 1, min_per_mille: int = 0) -> DataFrame:
    """``(item_a, item_b, n, n_a, n_b, n_ab, lift, expected, p_value, q_value)`` of every pair with n_ab >= min_count and
    n_ab * 1000 >= min_per_mille * n; item_a is the smaller.

    Items too rare for a wanted pair are left out before pairs are formed (a pair is never more frequent than its items),
    so nothing wanted is lost. n counts all records. q-values hold over all pairs of the items that are frequent enough for a
    wanted pair, those that never meet included (their p is 1). Empty tables give no rows.
    """
    spark = df.sparkSession
    b = written(baskets(df), "baskets")
    n = b.count()
    least = max(min_count, -(-min_per_mille * n // 1000))
    items = b.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("m")).where(F.col("m") >= least)
    items = written(items, "items")
    pruned = b.where(F.size("items") >= 2)
    # with a least share there are few such items, at most 1000 / min_per_mille times a basket's mean size, so each task can hold them
    kept = frozenset(r.item for r in items.select("item").collect()) if min_per_mille else None
    counted = pruned.mapInArrow(_pair_counts(kept), "item_a string, item_b string, n long").groupBy("item_a", "item_b").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= least)
    counted = counted.join(items.select(F.col("item").alias("item_a"), F.col("m").alias("n_a")), "item_a").join(items.select(F.col("item").alias("item_b"), F.col("m").alias("n_b")), "item_b")
    # classes: basket sizes and item frequencies, the latter in steps of 0.1 %, so both lists stay small at any size
    all_items = b.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("m"))
    step = F.when(F.col("m") <= 1000, F.col("m").cast("double")).otherwise(F.exp(F.round(F.log("m") * 1000) / 1000))
    ic = all_items.groupBy(step.alias("c")).agg(F.count("*").alias("k"), F.avg("m").alias("avg")).toPandas()  # <= 1000 + 1000 ln(rows / 1000)
    size = F.when(F.size("items") <= 1000, F.size("items").cast("double")).otherwise(F.exp(F.round(F.log(F.size("items")) * 1000) / 1000))
    bc = b.where(F.size("items") > 0).groupBy(size.alias("c")).agg(F.count("*").alias("k")).toPandas()
    x, y = fit(ic["avg"].to_numpy(float), ic["k"].to_numpy(float), bc["c"].to_numpy(float), bc["k"].to_numpy(float)) if len(ic) else (np.array([]), np.array([]))
    of, m = dict(zip(ic["c"].to_numpy(float), x, strict=True)), bc["k"].to_numpy(float)
    classes = np.array(sorted(of)) if of else np.array([1.0])
    params = np.array([of[c] for c in classes]) if of else np.array([0.0])

    def tails(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def near(c: np.ndarray) -> np.ndarray:
            c = c.astype(float)
            c = np.where(c <= 1000, c, np.exp(np.round(np.log(np.maximum(c, 1)) * 1000) / 1000))
            i = np.clip(np.searchsorted(classes, c), 1, max(len(classes) - 1, 1)) if len(classes) > 1 else np.zeros(len(c), int)
            if len(classes) > 1:
                i = np.where(np.abs(classes[i - 1] - c) <= np.abs(classes[i] - c), i - 1, i)
            return params[i]

        for f in frames:
            if not len(f):
                continue
            xa, xb = near(f["n_a"].to_numpy())[:, None] * y, near(f["n_b"].to_numpy())[:, None] * y
            p = xa / (1 + xa) * (xb / (1 + xb))
            f["expected"] = (p * m).sum(1)
            f["p_value"] = upper_tail(f["n_ab"].to_numpy(), p, m)
            yield f

    cols = "item_a string, item_b string, n_ab long, n_a long, n_b long"
    tested = written(counted.select("item_a", "item_b", "n_ab", "n_a", "n_b").mapInPandas(tails, cols + ", expected double, p_value double"), "tested")
    # Benjamini-Hochberg by bins of p, each bin at its upper edge: at most 300 * BIN bins, however many pairs
    bins = tested.groupBy(F.floor(-F.log10("p_value") * BIN).cast("int").alias("bin")).count().toPandas().sort_values("bin", ascending=False)
    rank = bins["count"].cumsum().to_numpy(float)
    few = items.count()
    total = few * (few - 1) / 2  # every pair that could have met is tested
    q = np.minimum.accumulate((10.0 ** (-bins["bin"].to_numpy(float) / BIN) * total / np.maximum(rank, 1))[::-1])[::-1] if len(bins) else np.array([])
    qs = spark.createDataFrame([(int(i), float(min(1, v))) for i, v in zip(bins["bin"], q, strict=True)], "bin int, q_value double")
    out = tested.withColumn("bin", F.floor(-F.log10("p_value") * BIN).cast("int")).join(F.broadcast(qs), "bin")
    return out.select("item_a", "item_b", F.lit(n).cast("long").alias("n"), "n_a", "n_b", "n_ab", (F.col("n_ab") * F.lit(float(n)) / F.col("n_a") / F.col("n_b")).alias("lift"), "expected", "p_value", "q_value")


def surprising(df: DataFrame, min_count: int = 5, min_per_mille: int = 1, lift: int = 3) -> DataFrame:
    """The pairs of :func:`co_occurrence` more frequent than the fitted null expects, with n_ab * n >= lift * n_a * n_b (in whole numbers).

    The case is fixed by counts and lift, so after the null the exact check decides; q_value tells how sure the surprise is."""
    d = "decimal(38,0)"
    over = co_occurrence(df, min_count, min_per_mille).where(F.col("n_ab") > F.col("expected"))
    return over.where(F.col("n_ab").cast(d) * F.col("n").cast(d) >= F.lit(lift).cast(d) * F.col("n_a").cast(d) * F.col("n_b").cast(d))


def significant(df: DataFrame, q: float = 0.05) -> DataFrame:
    """The pairs of :func:`co_occurrence` that the fitted null doesn't explain at a false-discovery rate of ``q``, of all pairs tested."""
    return co_occurrence(df).where((F.col("q_value") <= q) & (F.col("n_ab") > F.col("expected")))
