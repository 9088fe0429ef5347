"""Session helpers: a tuned local session, table access, and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("siltworks").config("spark.driver.memory", memory)
    for k, v in (LOCAL_CONF | {"spark.sql.shuffle.partitions": str(partitions)} | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; a private one only where that is unset (one machine)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="siltworks-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give fewer tasks than there are: for heavy work per row on small inputs; large inputs stay as they are."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: a lineage cut that keeps columnar pruning."""
    path = scratch(df.sparkSession, name)
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_scratch"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`written` wrote. Only for tables that nothing lazy reads any more: whatever was made of them is cut or written."""
    for t in tables:
        path = t.__dict__.pop("_scratch", None)
        if path:
            spark = t.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """After a phase of a long job: let go of its plans, so that Spark's cleaner deletes their shuffle files and checkpoints now and not whenever the driver runs out of memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
