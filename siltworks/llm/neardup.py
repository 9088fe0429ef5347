"""Problem 1: groups of conversations that are the same but for small edits, insertions or reordering.

Signature-coordinate inverted join. Of the word shingles of a conversation (within turns, so the order of turns doesn't
matter), COORDS min-hash coordinates are taken. Every document is posted under each (coordinate, value). Collisions are
counted per pair and pairs with at least MATCHES of them are kept, then checked exactly on their shingles:

* exact copies fold into one document first, by a hash of the whole conversation;
* star merge: in every posting list each document meets the list's first and last member only; groups of near copies,
  however large, come together in this linear step;
* prefix and skip merge for what is left: lists whose members are already in one group are skipped. A pair in different
  groups with MATCHES collisions has them all in the remaining lists, so the first of them stands among the rarest
  r - MATCHES + 1 lists of either document (r: the document's remaining lists). In these prefixes, over the lists of at most
  LONG_LIST members, documents meet; with each goes one byte of each of its coordinates, and a pair that has fewer than
  MATCHES bytes in common, so fewer collisions too, goes no further than the list where it meets;
* block merge: pairs whose first common list is longer have longer ones only in common. Such lists are cut into blocks of
  BLOCK members, and every two blocks meet in one task that counts common lists and common shingles of all their pairs at
  once. Documents that have too few shingles in common with all others together go before. No list or partner is dropped.

Groups are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import norm_role
from siltworks.llm.tokens import mix, shingles, tokenize
from siltworks.operators.components import connected_components
from siltworks.session import cut, discard, release, written

COORDS = 32
MATCHES = 6
SHINGLE = 5
COMMON = 0.5
CHECK_SHINGLE = 3
LONG_LIST = 256
BLOCK = 2048


def _lists(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a batch whose second column holds lists of texts, and the row of each."""
    col = batch.column(1)
    offsets = np.concatenate([[0], np.cumsum(np.diff(col.offsets.to_numpy()))])
    texts = col.flatten().to_pylist()
    t = tokenize(texts)
    h, at = shingles(t.h, t.doc, k)
    rows = np.searchsorted(offsets, t.doc[at], side="right") - 1 if len(h) else np.zeros(0, np.int64)
    return h, rows


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _signatures(coords: int, k: int):  # noqa: ANN202
    rng = np.random.default_rng(1)
    mul = rng.integers(1, 2**63, coords, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, coords, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            h, rows = _lists(b, k)
            has = np.zeros(b.num_rows, bool)
            first = np.nonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))[0] if len(h) else np.zeros(0, np.int64)
            has[rows[first]] = True
            sig = np.empty((len(first), coords), np.uint64)
            for j in range(coords if len(first) else 0):
                sig[:, j] = mix(np.minimum.reduceat(h * mul[j] + add[j], first) + np.uint64(j))
            offsets = np.concatenate([[0], np.cumsum(has * coords)]).astype(np.int32)
            words = -(-coords // 8)
            code = np.zeros((len(first), words * 8), np.uint8)
            code[:, :coords] = (sig >> np.uint64(56)).astype(np.uint8)
            starts = np.concatenate([[0], np.cumsum(has * words)]).astype(np.int32)
            code = pa.ListArray.from_arrays(pa.array(starts), pa.array(code.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.view(np.int64).ravel())), code], names=["row_id", "whole", "sig", "code"])

    return run


def _shingle_sets(k: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            h, rows = _lists(b, k)
            order = np.lexsort((h, rows))
            h, rows = h[order], rows[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])]) if len(h) else np.zeros(0, bool)
            run_start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
            nth = (np.arange(len(h)) - run_start).astype(np.uint64)  # repeated shingles count as often as they stand
            v = (mix(h + nth * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            offsets = np.searchsorted(rows, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(v))], names=["doc", "set"])

    return run


def conversations(df: DataFrame) -> DataFrame:
    """``(row_id, texts, whole)`` of the rows with turns; ``whole`` hashes roles (in their usual spelling) and values."""
    turns = F.col("conversations")
    texts = F.transform(turns, lambda t: F.coalesce(t["value"], F.lit("")))
    parts = F.transform(turns, lambda t: F.concat(norm_role(t["from"]), F.lit("\x1e"), F.coalesce(t["value"], F.lit(""))))
    return df.where(F.size(turns) > 0).select("row_id", texts.alias("texts"), F.md5(F.array_join(parts, "\x1f")).alias("whole"))


def _similar(docs: DataFrame, pairs: DataFrame, common: float, k: int) -> DataFrame:
    """Of ``pairs`` (a, b), those with at least ``common`` of the larger one's shingles in both."""
    ids = pairs.select(F.col("a").alias("row_id")).union(pairs.select("b")).distinct()
    sets = docs.select("row_id", "texts").join(ids, "row_id", "left_semi").mapInArrow(_shingle_sets(k), "doc long, set array<int>")
    sets = written(sets, "sets")
    j = pairs.join(sets.select(F.col("doc").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("doc").alias("b"), F.col("set").alias("sb")), "b")
    out = cut(j.where(F.size(F.array_intersect("sa", "sb")) >= F.lit(common) * F.greatest(F.size("sa"), F.size("sb"), F.lit(1))).select("a", "b"))
    discard(sets)
    return out


def groups(df: DataFrame, coords: int = COORDS, matches: int = MATCHES, common: float = COMMON, k: int = SHINGLE, check_k: int = CHECK_SHINGLE, long_list: int = LONG_LIST) -> DataFrame:
    """``(row_id, group_id)`` of every row that has turns; the group is its smallest row_id.

    ``df`` has row_id and conversations. Null and empty values are empty texts; rows whose conversations agree wholly are
    one group, also without any word. Rows without turns are left out. Empty tables give no rows.
    """
    spark = df.sparkSession
    docs = conversations(df)
    sig = written(docs.select("row_id", "texts", "whole").mapInArrow(_signatures(coords, k), "row_id long, whole string, sig array<long>, code array<long>"), "sig")
    same = sig.groupBy("whole").agg(F.min("row_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("whole", "rep")
    copies = cut(sig.select("row_id", "whole").join(same, "whole").select("row_id", "rep"))
    reps = sig.join(copies.where("row_id <> rep"), "row_id", "left_anti")
    posts = reps.select(F.col("row_id").alias("doc"), F.explode("sig").alias("k"))
    freq = posts.groupBy("k").agg(F.count("*").alias("c"), F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("c > 1")
    lists = written(posts.join(freq, "k"), "lists")

    star = lists.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("doc").alias("b")), F.struct(F.when(F.col("doc") != F.col("lo"), F.col("doc")).alias("a"), F.col("hi").alias("b")))).alias("p")).select("p.a", "p.b").where("a < b")
    star = cut(star.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= matches).select("a", "b"))
    release(spark)
    edges = _similar(docs, star, common, check_k)
    comp = cut(connected_components(edges))
    release(spark)

    more = residual_pairs(docs, lists, comp, sig.select(F.col("row_id").alias("doc"), "code"), coords, matches, long_list, common, check_k)
    discard(lists)
    if more is not None:
        release(spark)
        edges = edges.union(_similar(docs, more, common, check_k))
        comp = cut(connected_components(edges))
        release(spark)
    whole = copies.select("row_id", F.col("rep").alias("doc")).where("row_id <> doc")
    member = sig.select("row_id").join(whole, "row_id", "left").withColumn("doc", F.coalesce("doc", "row_id"))
    return member.join(comp.select(F.col("node").alias("doc"), "component"), "doc", "left").select("row_id", F.coalesce("component", "doc").alias("group_id"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each set of ``left`` has in common with each of ``right``; members that stand in the same sets count as one with a weight."""
    both = [*left, *right]
    n, out = len(left), np.zeros((len(left), len(right)), np.float32)
    of = np.repeat(np.arange(len(both)), [len(x) for x in both])
    item = np.unique(np.concatenate(both), return_inverse=True)[1] if len(of) else of
    order = np.argsort(item, kind="stable")
    item, of = item[order], of[order]
    if not len(item):
        return out
    start = np.nonzero(np.concatenate([[True], item[1:] != item[:-1]]))[0]
    shared = np.nonzero((of[start] < n) & (np.maximum.reduceat(of, start) >= n))[0]
    where = np.add.reduceat(mix(of.astype(np.uint64) + np.uint64(1)), start)
    _, one, times = np.unique(where[shared], return_index=True, return_counts=True)
    end = np.append(start[1:], len(item))
    for lo in range(0, len(one), 2000):
        cols = shared[one[lo : lo + 2000]]
        m = np.zeros((len(both), len(cols)), np.float32)
        size = end[cols] - start[cols]
        m[np.concatenate([of[a:b] for a, b in zip(start[cols], end[cols], strict=True)]), np.repeat(np.arange(len(cols)), size)] = 1
        out += (m[:n] * times[lo : lo + 2000].astype(np.float32)) @ m[n:].T
    return out


def _meet(matches: int, common: float):  # noqa: ANN202
    """Of two blocks of a list (or one with itself), links between components: as many as join what belongs together."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        sides = [g for _, g in f.groupby("side")]
        x, y = sides[0], sides[-1]
        if f["comp"].nunique() < 2 or (len(sides) == 1 and f["x"].iloc[0] != f["y"].iloc[0]):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        size = np.maximum.outer(x["set"].map(len).to_numpy(), y["set"].map(len).to_numpy())
        ok = overlaps(x["ks"].tolist(), y["ks"].tolist()) >= matches
        ok &= x["comp"].to_numpy()[:, None] != y["comp"].to_numpy()[None, :]
        if ok.any():
            ok &= overlaps(x["set"].tolist(), y["set"].tolist()) >= common * np.maximum(size, 1)
        root: dict[int, int] = {}

        def top(c: int) -> int:
            while (up := root.get(c, c)) != c:
                root[c] = c = root.get(up, up)
            return c

        links = []
        dx, cx, dy, cy = x["doc"].to_numpy(), x["comp"].to_numpy(), y["doc"].to_numpy(), y["comp"].to_numpy()
        for i, j in zip(*np.nonzero(ok), strict=True):
            u, v = top(cx[i]), top(cy[j])
            if u != v:
                root[u] = v
                links.append((min(dx[i], dy[j]), max(dx[i], dy[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return run


def _block_pairs(docs: DataFrame, per: DataFrame, hot: DataFrame, matches: int, common: float, k: int, block: int) -> DataFrame:
    """Links (a, b) among the members (doc, comp, k) of longer lists: whatever two alike documents of a list have, their components come together."""
    ids = hot.select("doc", "comp").distinct()
    sets = docs.select("row_id", "texts").join(ids.select(F.col("doc").alias("row_id")), "row_id", "left_semi").mapInArrow(_shingle_sets(k), "doc long, set array<int>")
    sets = written(sets.join(ids, "doc"), "hotsets")
    # a document that is alike to some other has the wanted share of its shingles in common with other components
    each = sets.select("doc", "comp", F.explode("set").alias("s"))
    open_ = each.groupBy("s").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("s")
    shared = each.join(open_, "s").groupBy("doc").agg(F.count("*").alias("m"))
    left = sets.join(shared, "doc").where(F.col("m") >= F.lit(common) * F.size("set")).select("doc", "set")
    left = cut(left.join(per.select("doc", F.transform("cks", lambda s: s["k"]).alias("ks")), "doc"))
    hot = cut(hot.join(left.select("doc"), "doc", "left_semi"))
    n = hot.groupBy("k").agg(F.ceil(F.count("*") / block).cast("int").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("k", "n")
    own = hot.join(n, "k").withColumn("side", F.pmod(F.xxhash64("doc"), F.col("n")).cast("int"))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    cells = cells.select("k", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "doc", "comp").join(left, "doc")
    return cells.groupBy("k", "x", "y").applyInPandas(_meet(matches, common), "a long, b long")


def _agree(a: list[F.Column], b: list[F.Column], coords: int) -> F.Column:
    """How many bytes the numbers ``a`` and ``b`` have in common, without those that fill the last number up: at least as many as the coordinates that are equal."""
    out = F.lit(coords)
    for x, y in zip(a, b, strict=True):
        z = x.bitwiseXOR(y)
        for n in (4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, n))
        out = out - F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))  # the lowest bit of each byte that isn't 0
    return out


def residual_pairs(docs: DataFrame, lists: DataFrame, comp: DataFrame, codes: DataFrame, coords: int, matches: int, long_list: int, common: float, k: int, block: int = BLOCK) -> DataFrame | None:
    """Pairs (a, b) in different components with at least ``matches`` common lists, None if there are none; of those that
    have only lists of more than ``long_list`` members in common, as many as join the components of all that are alike."""
    c = comp.select(F.col("node").alias("doc"), F.col("component").alias("comp"))
    own = lists.select("doc", "k", "c").join(c, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    open_ = own.groupBy("k").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("k")
    per = own.join(open_, "k", "left_semi").groupBy("doc", "comp").agg(F.sort_array(F.collect_list(F.struct("c", "k"))).alias("cks"))  # at most COORDS lists a document
    per = cut(per.where(F.size("cks") >= matches))

    first = F.slice("cks", 1, F.size("cks") - matches + 1)  # the first common list of a pair is in this prefix of both
    # it is of bounded length: the pair meets there
    words = range(-(-coords // 8))
    posts = per.join(codes, "doc").select("doc", "comp", *[F.get("code", F.lit(i)).alias(f"o{i}") for i in words], F.explode(F.filter(first, lambda s: s["c"] <= long_list)).alias("s"))
    posts = posts.select("doc", "comp", *[f"o{i}" for i in words], F.col("s.k").alias("k"))
    right = posts.select(F.col("doc").alias("b"), F.col("comp").alias("cb"), *[F.col(f"o{i}").alias(f"p{i}") for i in words], "k")
    met = posts.withColumnRenamed("doc", "a").join(right, "k").where("a < b and comp <> cb")
    pairs = met.where(_agree([F.col(f"o{i}") for i in words], [F.col(f"p{i}") for i in words], coords) >= matches).select("a", "b")
    # it is a longer one, so all are
    hot = cut(per.select("doc", "comp", F.explode(F.filter(first, lambda s: s["c"] > long_list)).alias("s")).select("doc", "comp", F.col("s.k").alias("k")))
    if not hot.isEmpty():
        pairs = pairs.union(_block_pairs(docs, per, hot, matches, common, k, block))
    ks = per.select("doc", F.transform("cks", lambda s: s["k"]).alias("ks"))
    j = pairs.distinct().join(ks.select(F.col("doc").alias("a"), F.col("ks").alias("ka")), "a").join(ks.select(F.col("doc").alias("b"), F.col("ks").alias("kb")), "b")
    out = cut(j.where(F.size(F.array_intersect("ka", "kb")) >= matches).select("a", "b"))
    return None if out.isEmpty() else out


def group_pairs(members: DataFrame) -> DataFrame:
    """``(row_id_a, row_id_b)`` of all pairs within the groups, the smaller first."""
    many = members.join(members.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1").select("group_id"), "group_id", "left_semi")
    many = cut(many)
    b = many.select("group_id", F.col("row_id").alias("row_id_b"))
    return many.select("group_id", F.col("row_id").alias("row_id_a")).join(b, "group_id").where("row_id_a < row_id_b").select("row_id_a", "row_id_b")
