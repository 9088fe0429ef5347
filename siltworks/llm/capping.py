"""Problem 6: at most so many records per contributor, the best by score.

Mergeable bounded heaps. Contributors above their cap are at most 1/share of all (n * share rows each), so their list is
small and proven so. Each input task keeps, per such contributor, only its cap's best (score, id) pairs in a heap of
bounded size; heaps merge as a tree. A heap may hold ``heap_limit`` pairs: while a cap is larger, the scores are first
narrowed by exact radix counts (map-side combined) to the one slice of the score order in which the cap falls, so a heap
only ever has to decide inside that slice. The decided cut is joined back to the full rows.
"""

from __future__ import annotations

import heapq
import struct
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RADIX_BITS = 12


def contributor(c: Column) -> Column:
    r"""A path's usual spelling: lower case, no blanks around it, ``/`` for ``\``, single slashes, without one leading ``./``."""
    p = F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"^[\s]+|[\s]+$", ""))), r"[\\/]+", "/")
    return F.regexp_replace(p, r"^\./", "")


def order_key(score: Column) -> Column:
    """A long that rises from the best score to the worst: numbers downward, then null and NaN together, -0.0 as 0.0."""
    return _order_key(F.when(score.isNull() | F.isnan(score), None).otherwise(score + F.lit(0.0)))


@F.pandas_udf(T.LongType())
def _order_key(s: pd.Series) -> pd.Series:
    import numpy as np

    x = s.to_numpy(dtype="float64", na_value=np.nan)
    b = (x + 0.0).view("int64")
    up = np.where(b >= 0, b, np.int64(-(2**63)) - b)  # rises with the number, symmetric about 0
    down = -up
    return pd.Series(np.where(np.isnan(x), np.int64(2**63 - 1), down))


def cut_points(keyed: DataFrame, caps: DataFrame, heap_limit: int = 200_000) -> DataFrame:
    """``(contributor, cut_key, cut_id)``: the last row that stays of each contributor in ``caps`` (contributor, cap).

    ``keyed`` has contributor, key, row_id, with ``row_id`` unique. A cap of 0 gives a cut before all rows.
    """
    spark = keyed.sparkSession
    # the slice of the key order in which the cap falls; narrowed while the rest of the cap is larger than a heap
    open_ = {r.contributor: [r.cap, -(2**63), 2**63 - 1, "key", 0] for r in caps.collect()}  # bounded by 1 / share
    done: dict[str, tuple[int, int]] = {c: (-(2**63), -(2**63)) for c, v in open_.items() if v[0] <= 0}
    open_ = {c: v for c, v in open_.items() if c not in done}
    while any(v[0] > heap_limit for v in open_.values()):
        wide = {c: v for c, v in open_.items() if v[0] > heap_limit}
        counted: dict[str, list[tuple[int, int]]] = {}
        for by in ("key", "row_id"):
            part = {c: v for c, v in wide.items() if (v[3] == "key") == (by == "key")}
            if not part:
                continue
            rows = spark.createDataFrame([(c, Decimal(v[1]), Decimal(max(1, -(-(v[2] - v[1] + 1) // 2**RADIX_BITS))), Decimal(v[2]), v[4]) for c, v in part.items()], "contributor string, lo decimal(20,0), step decimal(20,0), hi decimal(20,0), fixed long")
            j = keyed.join(F.broadcast(rows), "contributor").where(F.col(by).between(F.col("lo"), F.col("hi")))
            if by == "row_id":
                j = j.where("key = fixed")
            got = j.groupBy("contributor", F.floor((F.col(by).cast("decimal(20,0)") - F.col("lo")) / F.col("step")).cast("long").alias("bin")).count()
            for r in got.collect():  # at most 1 / share times 2**RADIX_BITS rows
                counted.setdefault(r.contributor, []).append((r.bin, r["count"]))
        for c, v in wide.items():
            step = max(1, -(-(v[2] - v[1] + 1) // 2**RADIX_BITS))
            for b, n in sorted(counted.get(c, [])):
                lo, hi = v[1] + b * step, min(v[2], v[1] + (b + 1) * step - 1)
                if n < v[0]:
                    v[0] -= n
                    continue
                v[1], v[2] = lo, hi
                if lo == hi and v[3] == "key":
                    v[1], v[2], v[3], v[4] = -(2**63), 2**63 - 1, "row_id", lo
                elif lo == hi:
                    done[c] = (v[4], lo)
                break
        open_ = {c: v for c, v in open_.items() if c not in done}
    if open_:
        rows = spark.createDataFrame([(c, v[0], v[1] if v[3] == "key" else v[4], v[2] if v[3] == "key" else v[4], v[1] if v[3] != "key" else -(2**63), v[2] if v[3] != "key" else 2**63 - 1) for c, v in open_.items()], "contributor string, cap long, key_lo long, key_hi long, id_lo long, id_hi long")
        inside = keyed.join(F.broadcast(rows), "contributor").where("key between key_lo and key_hi and row_id between id_lo and id_hi").select("contributor", "cap", "key", "row_id")
        rdd = inside.rdd.map(lambda r: (r[0], (r[1], r[2], r[3])))
        heaps = rdd.aggregateByKey(b"", _put, _merge).mapValues(_worst)
        found = heaps.collect()  # one pair per contributor, at most 1 / share
        done |= {c: w for c, w in found}
    return spark.createDataFrame([(c, k, i) for c, (k, i) in done.items()], "contributor string, cut_key long, cut_id long")


class _Heap:
    """The ``cap`` smallest (key, id) pairs, largest on top; it travels as bytes."""

    def __init__(self, cap: int, items: list | None = None) -> None:
        self.cap, self.items = cap, items or []

    def add(self, key: int, i: int) -> None:
        item = (-key, -i)
        if len(self.items) < self.cap:
            heapq.heappush(self.items, item)
        elif item > self.items[0]:
            heapq.heapreplace(self.items, item)

    def __getstate__(self) -> bytes:
        return struct.pack(f"<q{2 * len(self.items)}q", self.cap, *(max(min(x, 2**63 - 1), -(2**63)) for p in self.items for x in p))

    def __setstate__(self, b: bytes) -> None:
        cap, *flat = struct.unpack(f"<{len(b) // 8}q", b)
        self.cap, self.items = cap, list(zip(flat[::2], flat[1::2], strict=True))


def _put(heap, row):  # noqa: ANN001, ANN202
    h = heap or _Heap(row[0])
    h.add(row[1], row[2])
    return h


def _merge(a, b):  # noqa: ANN001, ANN202
    if not a or not b:
        return a or b
    if len(a.items) < len(b.items):
        a, b = b, a
    for k, i in b.items:
        a.add(-k, -i)
    return a


def _worst(h: _Heap) -> tuple[int, int]:
    return -h.items[0][0], -h.items[0][1]


def capped(df: DataFrame, share_percent: int = 2, heap_limit: int = 200_000) -> DataFrame:
    """All rows of ``df`` (row_id, metadata.source_file, value.value_score) with ``contributor`` and ``stays``.

    Rows with null ``metadata`` or ``source_file`` always stay. Null and NaN scores come after all numbers and equal each
    other; ties go to the smaller ``row_id``. An empty table gives no rows. Columns of other names pass through nothing:
    the result is (row_id, contributor, stays).
    """
    keyed = df.select("row_id", contributor(F.col("metadata.source_file")).alias("contributor"), order_key(F.col("value.value_score")).alias("key"))
    sizes = df.select(contributor(F.col("metadata.source_file")).alias("contributor")).groupBy("contributor").count()
    n = df.select(F.count("*").alias("n")).first().n
    cap = n * share_percent // 100
    caps = sizes.where(F.col("contributor").isNotNull() & (F.col("count") > cap)).select("contributor", F.lit(cap).cast("long").alias("cap"))
    cuts = cut_points(keyed.where("contributor is not null"), caps, heap_limit)
    out = keyed.join(F.broadcast(cuts), "contributor", "left")
    stays = F.col("cut_key").isNull() | (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (F.col("row_id") <= F.col("cut_id")))
    return out.select("row_id", "contributor", stays.alias("stays"))
