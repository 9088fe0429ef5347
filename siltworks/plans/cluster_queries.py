"""Queries over vectors: hashes, neighbours, components, representatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import text as T
from siltworks.operators import clustering as C
from siltworks.operators import slicing as SL
from siltworks.plans.base import q6, r6, turns
from siltworks.plans.registry import query
from siltworks.session import table, written





_CC = """e as (select n_nationkey::bigint as a, n_regionkey::bigint + 1000 as b from nation), v as (select a as node from e union select b from e), both_ as (select a, b from e union all select b, a from e),
  cc as (with recursive r(node, c) as (select node, node from v union select b.b, r.c from r join both_ b on b.a = r.node) select node, min(c) as component from r group by node)"""


@query(f"with {_CC} select node, component from cc")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    from siltworks.operators.components import connected_components as cc

    e = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("a"), (F.col("n_regionkey").cast("long") + 1000).alias("b"))
    return cc(e)


@query(f"with m as (select vec_id, label, embedding[1]::double as x from embeddings), b as (select label, max((x, vec_id)) as b from m group by label) select m.vec_id, m.label, {q6('m.x')} as x from m join b on b.label = m.label and b.b = (m.x, m.vec_id)")
def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "embeddings").select("vec_id", "label", F.element_at("embedding", 1).cast("double").alias("x"))
    r = C.representatives(m, "label", ["x", "vec_id"]).where("representative")
    return r.select("vec_id", "label", r6(F.col("x")).alias("x"))


@query("with s as (select label, count(*) as size from embeddings group by label), o as (select size, row_number() over (order by size) - 1 as i, count(*) over () as n from s) select sum(size)::bigint as windows, max(n) as clusters, count(*) filter (where size = 1) as singletons, min(size) filter (where i = least(floor(n * .5), n - 1)) as p50, min(size) filter (where i = least(floor(n * .9), n - 1)) as p90 from o")
def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    return C.cluster_stats(table(spark, d, "embeddings").withColumnRenamed("label", "cluster"))


@query()
def semantic_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Windows, hashed embeddings, sign-bit hashes, neighbours, components, representatives: the whole chain."""
    w = SL.windows(turns(spark, d), longer_than=6, size=6, stride=4)
    w = w.withColumn("window_id", F.concat_ws("_w", F.col("row_id").cast("string"), F.col("window_index").cast("string"))).withColumn("snr", T.snr(F.col("body"))).withColumn("text", T.transcript(F.col("body")))
    w = written(C.hashed(w.select("window_id", "row_id", "window_index", "snr", "text"), "text"), "windows")
    m = C.clusters(w, C.neighbours(w, w, "window_id"), "window_id").join(w.drop("embedding", "hash"), "window_id")
    r = C.representatives(m, "cluster", ["snr", "row_id", "window_index"])
    return r.select("window_id", "cluster", r6(F.col("snr")).alias("snr"), "representative")
