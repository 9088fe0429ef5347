"""Micro-batch forms of the batch operators: statistics that add up, and upserts of labelled slices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.session import scratch


def tag_counts(stream: DataFrame) -> DataFrame:
    """Running counts of a stream of (dim, tag) rows; stateful, for update or complete mode."""
    return stream.groupBy("dim", "tag").agg(F.count("*").alias("n"))


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Counts per time window, with a watermark that bounds the state and drops rows later than ``late``."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n"))


def deduplicated(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Rows delivered again within the watermark come once."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def upsert_sink(path: str, keys: list[str], order: list[str], buckets: int = 64, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps the row with the largest ``order`` columns of each key, in a table under ``path`` that is
    cut into ``buckets`` by a hash of the key.

    A batch rewrites only the buckets that it touches: version v of a bucket is the folder ``upsert_bucket=b/upsert_version=n``, and the manifest
    ``manifest/n`` names the version of every bucket after batch n. A manifest is written last, so a batch that failed
    halfway leaves no trace, and one that is repeated writes the same folders again. Versions that none of the last ``keep``
    manifests names are removed."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = _manifest(spark, path, batch_id - 1)
        rest = [c for c in batch.columns if c not in keys]
        new = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*") if rest else batch.distinct()
        new = new.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in new.select("_b").distinct().collect())  # at most ``buckets``
        if not touched:
            _write_manifest(spark, path, batch_id, now)
            return
        old = [f"{path}/upsert_bucket={b}/upsert_version={now[b]}" for b in touched if b in now]
        both = new if not old else new.unionByName(spark.read.schema(batch.schema).parquet(*old).withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        best = both.groupBy(*keys, "_b").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*", "_b") if rest else both.distinct()
        best.repartition("_b").withColumnRenamed("_b", "upsert_bucket").withColumn("upsert_version", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upsert_bucket", "upsert_version").parquet(path + "/")
        _write_manifest(spark, path, batch_id, now | dict.fromkeys(touched, batch_id))
        named = {(b, v) for n in range(max(0, batch_id - keep + 1), batch_id + 1) for b, v in _manifest(spark, path, n).items()}
        for b in touched:
            if b in now and (b, now[b]) not in named:
                _delete(spark, f"{path}/upsert_bucket={b}/upsert_version={now[b]}")

    return run


def read_upserted(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """The table of :func:`upsert_sink` after a batch."""
    parts = [f"{path}/upsert_bucket={b}/upsert_version={v}" for b, v in _manifest(spark, path, batch_id).items()]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _manifest(spark: SparkSession, path: str, batch_id: int) -> dict[int, int]:
    at = f"{path}/manifest/{batch_id}"
    return {r.bucket: r.v for r in spark.read.schema("bucket int, v long").json(at).collect()} if batch_id >= 0 and _exists(spark, at) else {}  # one row a bucket


def _write_manifest(spark: SparkSession, path: str, batch_id: int, now: dict[int, int]) -> None:
    spark.createDataFrame(sorted(now.items()), "bucket int, v long").coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], name: str = "stream") -> None:
    """Process what there is and stop; the stream's own checkpoint lies in the shared folder."""
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", scratch(stream.sparkSession, name)).trigger(availableNow=True).start()
    q.awaitTermination()
