"""Problem 2: how often every distinct tag occurs, in how many records, and which are too rare or too common.

Recursive radix spilling. Each task counts its own rows first (a term comes out once per input chunk), then the counts are
written to the shared folder by the first hash bits of (field, tag). A partition over the size limit is split by its next
bits, until it fits or holds one hash value only. Each leaf is aggregated by one task with DuckDB, out of core: it streams
the leaf's files under a memory limit and may spill beside them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import latest, norm_tag
from siltworks.session import scratch

FIELDS = ("concept", "domain", "task", "language")
BITS = 4
CHUNK = 200_000


def record_tags(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(field, tag, occurrences)`` per record and distinct tag, of the latest row of each ``id``. Null and empty tags are ignored."""
    one = latest(df, [F.col("labels").getField(f).alias(f) for f in fields])
    pairs = F.flatten(F.array(*[F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), _named(f)) for f in fields]))
    return one.select(F.filter(pairs, lambda p: p["tag"].isNotNull() & (p["tag"] != "")).alias("pairs"))


def _named(field: str):  # noqa: ANN202
    return lambda t: F.struct(F.lit(field).alias("field"), norm_tag(t).alias("tag"))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of this task's records by (field, tag, hash), flushed every CHUNK distinct terms."""
    import xxhash

    counts: dict[tuple[str, str], list[int]] = {}

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        out = pa.RecordBatch.from_pydict({
            "field": pa.array([f for f, _ in keys], pa.string()), "tag": pa.array([t for _, t in keys], pa.string()),
            "h": pa.array([xxhash.xxh64_intdigest(f"{f}\0{t}") >> 4 for f, t in keys], pa.int64()),
            "n_occ": pa.array([counts[k][0] for k in keys], pa.int64()), "n_rec": pa.array([counts[k][1] for k in keys], pa.int64()),
        })
        counts.clear()
        return out

    for b in batches:
        for pairs in b.column(0).to_pylist():
            own: dict[tuple[str, str], int] = {}
            for p in pairs or ():
                k = (p["field"], p["tag"])
                own[k] = own.get(k, 0) + 1
            for k, n in own.items():
                c = counts.setdefault(k, [0, 0])
                c[0] += n
                c[1] += 1
        if len(counts) >= CHUNK:
            yield flush()
    if counts:
        yield flush()


PARTIAL = "field string, tag string, h long, n_occ long, n_rec long"


def _sizes(spark, path: str) -> dict[int, int]:  # noqa: ANN001
    """Bytes of each radix folder under ``path``, from the file system's listing."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("radix="):
            out[int(name[6:])] = fs.getContentSummary(s.getPath()).getLength()
    return out


def _leaf(frames: Iterator[pd.DataFrame], memory: str) -> Iterator[pd.DataFrame]:
    import os

    import duckdb
    import pyarrow.dataset as ds
    from pyarrow import fs as pafs

    for f in frames:
        for path in f["path"]:
            where, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
            con = duckdb.connect()
            con.execute(f"set memory_limit='{memory}'; set threads=1; set preserve_insertion_order=false")
            if isinstance(where, pafs.LocalFileSystem):  # spill beside the leaf, in the shared folder
                con.execute(f"set temp_directory='{os.path.join(os.path.dirname(inner.rstrip('/')), 'spill-' + uuid.uuid4().hex)}'")
            else:  # a leaf on a remote file system is small enough for memory (leaf_bytes), so nothing spills to a local disk
                con.execute("set temp_directory=''")
            terms = ds.dataset(inner, filesystem=where, format="parquet", exclude_invalid_files=False).scanner(columns=["field", "tag", "n_occ", "n_rec"], batch_size=65536).to_reader()  # noqa: F841
            got = con.execute("select field, tag, sum(n_occ)::bigint as n_occ, sum(n_rec)::bigint as n_rec from terms group by all")
            while len(part := got.fetch_df_chunk(32)):
                yield part[["field", "tag", "n_occ", "n_rec"]]
            con.close()


def term_counts(partial: DataFrame, leaf_bytes: int = 256 << 20, memory: str = "512MB") -> DataFrame:
    """``(field, tag, n_occ, n_rec)`` from partial counts (field, tag, h, n_occ, n_rec), by recursive radix spilling."""
    spark = partial.sparkSession
    leaves: list = []
    todo, level = partial, 0
    while todo is not None:  # one write a level, whatever number of partitions is split
        path = scratch(spark, f"radix{level}")
        shown = todo.withColumn("radix", F.shiftrightunsigned("h", 60 - BITS * (level + 1)))  # all bits so far, so that parts of several partitions stay apart
        shown.write.option("compression", "zstd").partitionBy("radix").parquet(path)
        large = []
        for part, size in _sizes(spark, path).items():
            at = f"{path}/radix={part}"
            (large if size > leaf_bytes and BITS * (level + 2) <= 60 else leaves).append(at)
        level += 1
        todo = spark.read.schema(PARTIAL).parquet(*large) if large else None
    leaves = [(p,) for p in leaves]
    if not leaves:
        return spark.createDataFrame([], "field string, tag string, n_occ long, n_rec long")
    tasks = spark.createDataFrame(leaves, "path string").repartitionByRange(len(leaves), "path")
    return tasks.mapInPandas(lambda it: _leaf(it, memory), "field string, tag string, n_occ long, n_rec long")


def tag_frequency(df: DataFrame, rare_max: int = 2, common_percent: int = 12, leaf_bytes: int = 256 << 20) -> DataFrame:
    """``(field, tag, occurrences, records, mark)`` of every distinct tag; mark is rare, common or null.

    ``df`` has id, row_id, ingested_at and labels. A tag repeated in a record adds to occurrences, once to records. An
    empty table gives no rows. A tag both rare and common (tiny tables) is rare.
    """
    n = df.select(F.countDistinct("id").alias("d"), F.count(F.when(F.col("id").isNull(), 1)).alias("z")).first()
    total = n.d + n.z
    partial = record_tags(df).mapInArrow(_count_batches, PARTIAL)
    mark = F.when(F.col("n_rec") <= rare_max, "rare").when(F.col("n_rec") * 100 > F.lit(total * common_percent), "common")
    return term_counts(partial, leaf_bytes).select("field", "tag", F.col("n_occ").alias("occurrences"), F.col("n_rec").alias("records"), mark.alias("mark"))
