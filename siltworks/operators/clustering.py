"""Semantic clusters of windows: hashed embeddings, sign-bit hashes in bands, a neighbour graph, components, representatives.

Windows with equal hashes fold into one node first, so copies don't fill a band's bucket. A bucket over ``hot`` nodes is cut
into blocks of about that many, and every two blocks meet in a task of their own; all pairs of a bucket within the radius
are kept, whatever its size (by the pigeonhole rule they agree in at least one band when the radius is below the band count;
above that banding is approximate, as in any banded search)."""

from __future__ import annotations

import hashlib
import json
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import CLUSTER
from siltworks.operators.components import connected_components
from siltworks.session import cut, discard, release, written


def hyperplanes(dim: int, bits: int, seed: int) -> np.ndarray:
    """Unit normals from a seeded generator, bits x dim."""
    r = random.Random(seed)
    p = np.array([[r.uniform(-1.0, 1.0) for _ in range(dim)] for _ in range(bits)])
    return p / np.linalg.norm(p, axis=1, keepdims=True)


class Grams:
    """Signed counts of the hashed character trigrams of texts in lower case with single blanks. A trigram's place and sign are
    hashed once: those of ASCII stand in a table, others are sorted first."""

    def __init__(self, dim: int, chars: int = 1 << 20) -> None:
        self.dim, self.chars, self.known, self.memo = dim, chars, np.full(1 << 21, -1, np.int32), {}

    def code(self, gram: str) -> int:
        d = hashlib.blake2b(gram.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        return int.from_bytes(d[:4], "big") % self.dim * 2 + (d[4] & 1)

    def codes(self, c: np.ndarray) -> np.ndarray:
        """Place and sign of the trigrams that begin at each but the last two of the characters ``c``."""
        c = c.astype(np.int64)
        key = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
        wide = (c >= 128).astype(np.int8)
        wide = (wide[:-2] | wide[1:-1] | wide[2:]).astype(bool)
        short = np.where(wide, 0, c[:-2] << 14 | c[1:-1] << 7 | c[2:])
        if (new := (self.known[short] < 0) & ~wide).any():
            for x in np.unique(short[new]).tolist():
                self.known[x] = self.code(chr(x >> 14) + chr(x >> 7 & 127) + chr(x & 127))
        out = self.known[short]
        if wide.any():
            if len(self.memo) > 500_000:
                self.memo.clear()
            u, at = np.unique(key[wide], return_inverse=True)
            for x in u.tolist():
                if x not in self.memo:
                    self.memo[x] = self.code(chr(x >> 42) + chr(x >> 21 & 0x1FFFFF) + chr(x & 0x1FFFFF))
            out[wide] = np.array([self.memo[x] for x in u.tolist()], np.int32)[at]
        return out

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """A row a text, int32; empty texts give zeros."""
        out = np.zeros((len(texts), self.dim), np.int32)
        clean = [f" {t} " if (t := " ".join((x or "").split()).lower()) else "" for x in texts]
        size = np.array([len(t) for t in clean], np.int64)
        block = np.cumsum(size) // self.chars
        for lo, hi in zip(at := np.flatnonzero(np.diff(block, prepend=-1)), [*at[1:], len(texts)], strict=False):
            n = size[lo:hi]
            if not n.any():
                continue
            c = np.frombuffer("".join(clean[lo:hi]).encode("utf-32-le", "surrogatepass"), np.uint32)
            row = np.repeat(np.arange(hi - lo), n)
            own = row[2:] == row[:-2]
            code = self.codes(c)[own]
            out[lo:hi] = np.bincount(row[:-2][own] * self.dim + (code >> 1), weights=1.0 - 2 * (code & 1), minlength=(hi - lo) * self.dim).reshape(hi - lo, self.dim)
        return out


def unit(counts: np.ndarray) -> np.ndarray:
    """Rows of unit length, float32; zeros stay zeros."""
    v = counts.astype(np.float64)
    n = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return (v / np.where(n > 0, n, 1)).astype(np.float32)


def packed(counts: np.ndarray) -> list[bytes]:
    """Each row as bytes, one or four a value."""
    narrow, fits = counts.astype(np.int8), (np.abs(counts) < 128).all(axis=1)
    return [narrow[i].tobytes() if fits[i] else counts[i].astype("<i4").tobytes() for i in range(len(counts))]


def matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """The vectors of an Arrow column, float32 a row: arrays of floats as they are, packed counts brought to unit length."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        rows = column.to_pylist()
        dim = dim or min(map(len, rows), default=0)
        return unit(np.stack([np.frombuffer(x, np.int8 if len(x) == dim else "<i4") for x in rows]) if rows else np.zeros((0, dim)))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1 if len(column) else dim or 0)


def _floats(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel(), pa.float32()))


def _words(hashes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * hashes.shape[1]), pa.array(hashes.ravel(), pa.int64()))


def _signs(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return np.packbits(vectors.astype(np.float64) @ planes.T >= 0, axis=1, bitorder="little").view("<i8") if len(vectors) else np.zeros((0, len(planes) // 64), np.int64)


def embeddings(df: DataFrame, key: str, text: str, dim: int = CLUSTER["dim"]) -> DataFrame:
    """``(key, embedding array<float>)``; empty texts give zero vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(dim)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _floats(unit(grams.counts(b.column(1).to_pylist())))], names=[key, "embedding"])

    return df.select(key, text).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, embedding array<float>")


def hashed(df: DataFrame, text: str, dim: int = CLUSTER["dim"], bits: int = CLUSTER["bits"], seed: int = CLUSTER["seed"]) -> DataFrame:
    """The other columns of ``df`` with ``embedding``, the packed counts of :class:`Grams`, and ``hash`` as by :func:`semhash`: texts are read once and neither they nor floats are written."""
    keep = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, planes = Grams(dim), hyperplanes(dim, bits, seed)
        for b in batches:
            n = grams.counts(b.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(packed(n), pa.binary()), _words(_signs(unit(n), planes))], names=[*keep, "embedding", "hash"])

    return df.select(*keep, text).mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != text) + ", embedding binary, hash array<long>")


def semhash(df: DataFrame, key: str, vector: str = "embedding", dim: int = CLUSTER["dim"], bits: int = CLUSTER["bits"], seed: int = CLUSTER["seed"]) -> DataFrame:
    """``(key, hash array<long>)``: the sign bits of the projections, 64 to a word, lowest bit first."""
    planes = hyperplanes(dim, bits, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _words(_signs(matrix(b.column(1), dim), planes))], names=[key, "hash"])

    return df.where(F.col(vector).isNotNull()).select(key, vector).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, hash array<long>")


def bands(hash_: Column, bits: int = CLUSTER["bits"], n: int = CLUSTER["bands"]) -> Column:
    """The hash in ``n`` equal parts, lowest first; each at most 64 bits wide and dividing a word."""
    width = bits // n
    per = 64 // width
    mask = (1 << width) - 1 if width < 64 else -1
    return F.array(*[F.shiftrightunsigned(F.element_at(hash_, i // per + 1), (i % per) * width).bitwiseAND(F.lit(mask)) for i in range(n)])


def _whole(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """Sorted rows, about a batch at a time, cut where the first ``n`` columns change."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        at = np.flatnonzero(_changes([held[-1].slice(held[-1].num_rows - 1), b], n)[1:] if held else _changes([b], n))
        if len(at) and (held or at[-1]):
            yield pa.Table.from_batches([*held, b.slice(0, at[-1])])
            held = []
        held.append(b.slice(at[-1] if len(at) else 0))
    if held:
        yield pa.Table.from_batches(held)


def _changes(batches: list[pa.RecordBatch], n: int) -> np.ndarray:
    """Whether each row's first ``n`` columns differ from those of the row before."""
    keys = np.concatenate([np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:n]], axis=1) for b in batches])
    return np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]


def _exact(v: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 4096) -> np.ndarray:
    """Dot products of rows, in doubles and in the order of the columns, so they don't depend on how rows lie."""
    return np.concatenate([np.zeros(0), *(np.cumsum(v[a[i : i + block]].astype(np.float64) * v[b[i : i + block]], axis=1)[:, -1] for i in range(0, len(a), block))])


def _near(hash_a: np.ndarray, hash_b: np.ndarray, radius: int) -> np.ndarray:
    d = np.zeros((len(hash_a), len(hash_b)), np.int16)
    for w in range(hash_a.shape[1]):
        d += np.bitwise_count(hash_a[:, w, None] ^ hash_b[None, :, w])
    return d <= radius


def _split(hashes: np.ndarray, bits: int, n_bands: int) -> np.ndarray:
    """:func:`bands` of rows of unsigned words."""
    width = bits // n_bands
    per, mask = 64 // width, np.uint64((1 << width) - 1)
    return np.stack([hashes[:, i // per] >> np.uint64(i % per * width) & mask for i in range(n_bands)], axis=1)


def _best(sim: np.ndarray, top_k: int) -> np.ndarray:
    """In each row, what may be among the ``top_k``; sums of other orders differ by far less than 1e-9."""
    if sim.shape[1] <= top_k:
        return np.ones(sim.shape, bool)
    return sim >= np.partition(sim, -top_k, axis=1)[:, -top_k, None] - 1e-9


class Cells:
    """Sorted rows of whole cells: where each stands, its hash and its vector."""

    def __init__(self, t: pa.Table, radius: int, n_bands: int, bits: int) -> None:
        self.band, self.x, self.y, self.side = (t.column(k).to_numpy() for k in ("i", "x", "y", "side"))
        self.words = t.column("hash").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(t.num_rows, bits // 64)
        self.parts, self.radius, self.vectors = _split(self.words, bits, n_bands), radius, t.column("embedding").combine_chunks()

    def unit(self, rows: np.ndarray) -> np.ndarray:
        return matrix(self.vectors.take(pa.array(rows)))

    def similar(self, a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        used, at = np.unique(np.r_[a, b], return_inverse=True)
        v = self.unit(used)
        s = _exact(v, at[: len(a)], at[len(a) :])
        return a[ok := s >= cosine], b[ok], s[ok]


def _few(c: Cells, rows: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within the radius of cells of few rows, listed; ``cell`` numbers them in order."""
    ends = np.searchsorted(cell, cell, side="right")
    n = ends - np.arange(len(rows)) - 1
    a = np.repeat(np.arange(len(rows)), n)
    b = rows[a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)]
    a = rows[a]
    ok = (c.x[a] == c.y[a]) | (c.side[a] != c.side[b])
    a, b = a[ok], b[ok]
    ok = np.bitwise_count(c.words[a] ^ c.words[b]).sum(axis=1, dtype=np.int64) <= c.radius
    a, b = a[ok], b[ok]
    seen = ((c.parts[a] == c.parts[b]) & (np.arange(c.parts.shape[1]) < c.band[a, None])).any(axis=1)
    return np.r_[a[~seen], b[~seen]], np.r_[b[~seen], a[~seen]]


def _many(c: Cells, lo: int, hi: int, cosine: float, top_k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of a cell those within the radius that may be among its ``top_k``."""
    rows, x, y, band = np.arange(lo, hi), c.x[lo], c.y[lo], c.band[lo]
    left, right = (rows[c.side[lo:hi] == x], rows[c.side[lo:hi] == y]) if x != y else (rows, rows)
    near = _near(c.words[left], c.words[right], c.radius)
    if x == y:
        np.fill_diagonal(near, False)
    left, near = left[some := near.any(axis=1)], near[some]
    right, near = right[some := near.any(axis=0)], near[:, some]
    if not near.size:
        return left, right
    sim = np.where(near, c.unit(left).astype(np.float64) @ c.unit(right).astype(np.float64).T, -np.inf)
    first = near & (sim >= cosine - 1e-9)
    for j in range(band):
        first &= c.parts[left, j, None] != c.parts[None, right, j]
    a, b = np.nonzero(first & _best(sim, top_k))
    a, b = left[a], right[b]
    if x != y:
        d, e = np.nonzero(first & _best(sim.T, top_k).T)
        a, b = np.r_[a, right[e]], np.r_[b, left[d]]
    return a, b


def neighbours(vectors: DataFrame, hashes: DataFrame, key: str, radius: int = CLUSTER["radius"], cosine: float = CLUSTER["cosine"], top_k: int = CLUSTER["top_k"], n_bands: int = CLUSTER["bands"], bits: int = CLUSTER["bits"], hot: int = 1000) -> DataFrame:
    """``(a, b, similarity)``: of each node its ``top_k`` most similar others within the radius, ties to the larger key; plus
    a link of similarity 1 from each copy to its group's smallest key. ``embedding`` may be floats or packed counts."""
    groups = hashes.groupBy("hash").agg(F.min(key).alias("rep"))
    copies = hashes.join(groups, "hash").where(F.col(key) != F.col("rep")).select(F.col(key).alias("a"), F.col("rep").alias("b"), F.lit(1.0).alias("similarity"))
    nodes = cut(groups.select(F.col("rep").alias("k"), "hash"))
    posts = nodes.select("k", F.posexplode(bands(F.col("hash"), bits, n_bands)).alias("i", "v"))
    live = posts.withColumn("n", F.ceil(F.count("*").over(Window.partitionBy("i", "v")) / hot).cast("int")).withColumn("c", F.count("*").over(Window.partitionBy("i", "v"))).where("c > 1").drop("c")
    v = vectors.select(F.col(key).alias("k"), "embedding").join(nodes, "k")
    live = live.join(v, "k").withColumn("side", F.pmod(F.xxhash64("k"), F.col("n")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    cell = ["i", "v", "x", "y"]
    live = live.select("i", "v", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "k", "hash", "embedding").repartition(*cell).sortWithinPartitions(*cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches, len(cell)):
            at = np.flatnonzero(_changes(t.combine_chunks().to_batches(), len(cell)))
            size = np.diff([*at, t.num_rows])
            few, c = np.repeat(size <= top_k + 1, size), Cells(t, radius, n_bands, bits)  # nothing of a few can be beyond the top
            met = [_few(c, np.flatnonzero(few), np.repeat(np.arange(len(at)), size)[few]), *(_many(c, at[j], at[j] + size[j], cosine, top_k) for j in np.flatnonzero(size > top_k + 1))]
            a, b, s = c.similar(*map(np.concatenate, zip(*met, strict=True)), cosine)
            k = t.column("k").combine_chunks()
            yield pa.RecordBatch.from_arrays([k.take(pa.array(a)), k.take(pa.array(b)), pa.array(s)], names=["a", "b", "similarity"])

    kind = dict(hashes.dtypes)[key]
    w = Window.partitionBy("a").orderBy(F.desc("similarity"), F.desc("b"))
    return live.mapInArrow(run, f"a {kind}, b {kind}, similarity double").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_k).drop("_r").union(copies)


def clusters(keys: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``(key, cluster)``: components, named by their smallest key; a node without edges is its own."""
    spark = edges.sparkSession
    links = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    release(spark)  # what the search shuffled
    comp = written(connected_components(links), "components")
    discard(links)
    release(spark)
    return keys.select(key).join(comp.select(F.col("node").alias(key), "component"), key, "left").select(key, F.coalesce("component", key).alias("cluster"))


def representatives(members: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Adds representative: the row with the largest ``order`` columns of its cluster; nulls are the smallest."""
    best = members.groupBy(by).agg(F.max_by(F.struct(*order), F.struct(*order)).alias("_b"))
    return members.join(best, by).withColumn("representative", F.struct(*order).eqNullSafe(F.col("_b"))).drop("_b")


def cluster_stats(members: DataFrame, by: str = "cluster") -> DataFrame:
    """One row: windows, clusters, singletons, their share, mean size, and the sizes at half and nine tenths of the order."""
    sizes = members.groupBy(by).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("c"))  # one row a distinct size
    w = Window.orderBy("size")
    run = sizes.withColumn("hi", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy(F.lit(1))))
    at = lambda p: F.min(F.when(F.col("hi") > F.least(F.floor(F.col("n") * p), F.col("n") - 1), F.col("size")))
    return run.agg(F.sum(F.col("size") * F.col("c")).alias("windows"), F.max("n").alias("clusters"), F.coalesce(F.sum(F.when(F.col("size") == 1, F.col("c"))), F.lit(0)).alias("singletons"), at(0.5).alias("p50"), at(0.9).alias("p90"))


def export_clusters(members: DataFrame, windows: DataFrame, all_members: bool = False) -> DataFrame:
    """Members joined with their windows, representatives alone unless ``all_members``; a member without its window is an error."""
    m = members if all_members else members.where("representative")
    lost = m.join(windows.select("window_id"), "window_id", "left_anti").count()
    if lost:
        raise ValueError(f"{lost} members refer to windows that are missing")
    return m.join(windows, "window_id")


def compatibility_key(**params: object) -> str:
    """A hash of the parameters that results depend on: artefacts of another key aren't resumed."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()
