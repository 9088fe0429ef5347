"""Neighbours and hashed embeddings against plain versions of themselves, and what they shuffle."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltworks.operators import clustering as CL
from siltworks.session import written

TEXTS = ["The quick  brown\tFOX", "x", "", None, "   ", "Ärger 你好 \U0001f600 mixed 你好", "a\x00b c", "İstanbul \ud800 lone", "ab" * 900, "你", "the end"]


def plain(text, dim):
    v = np.zeros(dim, np.int64)
    t = " ".join((text or "").split()).lower()
    for i in range(len(t) and len(f" {t} ") - 2):
        d = hashlib.blake2b(f" {t} "[i : i + 3].encode("utf-8", "surrogatepass"), digest_size=16).digest()
        v[int.from_bytes(d[:4], "big") % dim] += -1 if d[4] & 1 else 1
    return v


@pytest.mark.parametrize("chars", [1, 7, 1 << 20])
def test_counts_of_trigrams(chars):
    grams = CL.Grams(32, chars)
    for texts in (TEXTS, TEXTS[::-1], [], [""], ["", None, "abc"]):
        got = grams.counts(texts)
        assert got.shape == (len(texts), 32) and [r.tolist() for r in got] == [plain(t, 32).tolist() for t in texts]
    m = grams.counts(TEXTS)
    assert max(abs(m).max(axis=1)) > 127 and (CL.matrix(pa.array(CL.packed(m), pa.binary()), 32) == CL.unit(m)).all()


def test_hashed_equals_embedding_and_semhash(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if not t or "\ud800" not in t], "k long, t string").withColumn("more", F.col("k") * 2)
    v = CL.embeddings(df, "k", "t", 64)
    want = {r.k: (r.hash, r.embedding) for r in CL.semhash(v, "k", dim=64, bits=128).join(v, "k").collect()}
    got = CL.hashed(df, "t", dim=64, bits=128).collect()
    assert {r.k: (r.hash, CL.matrix(pa.array([bytes(r.embedding)], pa.binary()), 64)[0].tolist()) for r in got} == want and all(r.more == 2 * r.k for r in got)


def near_vectors(n, dim, spread):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=dim)
    return [(f"w{i}", (centre + rng.normal(size=dim) * spread).astype(np.float32).tolist()) for i in range(n)]


def all_pairs(rows, hashes, radius, cosine, top_k, bits, n_bands):
    """Every two nodes compared, sums in the order of the columns."""
    width, out = bits // n_bands, []
    number = {k: sum((w % 2**64) << 64 * i for i, w in enumerate(h)) for k, h in hashes.items()}
    part = {k: [x >> width * i & (1 << width) - 1 for i in range(n_bands)] for k, x in number.items()}
    for k, e in rows:
        at = [(float(np.cumsum(np.multiply(e, f))[-1]), o) for o, f in rows if o != k and (number[k] ^ number[o]).bit_count() <= radius and any(map(int.__eq__, part[k], part[o]))]
        out += [(k, o, s) for s, o in sorted((x for x in at if x[0] >= cosine), reverse=True)[:top_k]]
    return sorted(out)


@pytest.mark.parametrize("batch", [7, 10_000])
def test_neighbours_equal_comparing_all_pairs(spark, batch):
    rows = near_vectors(90, 64, 1.1)
    rows[5] = ("w5", [2 * x for x in rows[4][1]])  # an equal hash: a copy
    rows = [(k, [float(np.float32(x)) for x in e]) for k, e in rows]
    v = spark.createDataFrame(rows, "k string, embedding array<float>")
    h = CL.semhash(v, "k", dim=64, bits=64)
    hashes = {r.k: r.hash for r in h.collect()}
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for top_k in (3, 200):
            want = all_pairs([r for r in rows if r[0] != "w5"], hashes, 28, 20.0, top_k, 64, 8) + [("w5", "w4", 1.0)]
            for hot in (1000, 20, 1):
                got = CL.neighbours(v, h, "k", radius=28, cosine=20.0, top_k=top_k, n_bands=8, bits=64, hot=hot).collect()
                assert sorted(map(tuple, got)) == sorted(want) and len(got) > 200
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_neighbours_shuffle_no_pair_of_a_bucket(spark):
    """400 nodes near each other have 80,000 pairs: two vectors a pair would be 240 MB, a vector a band is 5."""
    v = written(spark.createDataFrame(near_vectors(400, 384, 0.1), "k string, embedding array<float>"), "near")
    h = written(CL.semhash(v, "k"), "near_hashes")
    moved = lambda: sum(e.totalShuffleWrite() for e in (x.apply(i) for x in [spark.sparkContext._jsc.sc().statusStore().executorList(False)] for i in range(x.size())))
    before, was = moved(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as on tables too large for it
    try:
        assert CL.neighbours(v, h, "k", cosine=0.0).count() == 400 * 32
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert 1e5 < moved() - before < 20e6
