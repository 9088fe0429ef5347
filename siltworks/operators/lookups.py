"""Lookups between slices, conversations, earlier runs and other models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, by: list[str], order: list, keep_nulls: bool = False) -> DataFrame:
    """The first row of each key by ``order``: an aggregation with map-side combine, not a sort of the group."""
    if not keep_nulls:
        for k in by:
            df = df.where(F.col(k).isNotNull())
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*by, "_r.*")


def conversation_lookup(slices: DataFrame, records: DataFrame) -> DataFrame:
    """``slices`` (conversation_key, conversation_uid, source_id) with conv_value and conv_selection and the way they were
    found: by key, else by uid, else by an id that only one record has. Several records of one key: the smallest file."""
    order = [F.coalesce("source_file", F.lit("")), "conv_value", "conv_selection"]
    val = ["conv_value", "conv_selection", "source_file"]
    by_key = first_rows(records.select("conversation_key", *val), ["conversation_key"], order).select(F.col("conversation_key").alias("_k"), F.struct("conv_value", "conv_selection").alias("_vk"))
    by_uid = first_rows(records.select("conversation_uid", *val), ["conversation_uid"], order).select(F.col("conversation_uid").alias("_u"), F.struct("conv_value", "conv_selection").alias("_vu"))
    legacy = records.where(F.col("conversation_id").isNotNull()).groupBy("conversation_id").agg(F.count("*").alias("n"), F.first(F.struct("conv_value", "conv_selection")).alias("_vi")).where("n = 1").select(F.col("conversation_id").alias("_i"), "_vi")
    j = slices.join(by_key, F.col("conversation_key") == F.col("_k"), "left").join(by_uid, F.col("conversation_uid") == F.col("_u"), "left").join(legacy, F.col("source_id") == F.col("_i"), "left")
    how = F.when(F.col("_vk").isNotNull(), "key").when(F.col("_vu").isNotNull(), "uid").when(F.col("_vi").isNotNull(), "legacy").otherwise("none")
    v = F.coalesce("_vk", "_vu", "_vi")
    return j.select(*slices.columns, how.alias("found_by"), v["conv_value"].alias("conv_value"), v["conv_selection"].alias("conv_selection"))


def resume(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an earlier run hasn't done."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def migrate(new: DataFrame, old: DataFrame, key: str, column: str, order: list) -> DataFrame:
    """``column`` copied forward from the first old row of the same key, where the new row has none."""
    src = first_rows(old.select(key, column, *[o for o in order if isinstance(o, str)]), [key], order).select(F.col(key).alias("_k"), F.col(column).alias("_v"))
    return new.join(src, F.col(key) == F.col("_k"), "left").withColumn(column, F.coalesce(column, "_v")).drop("_k", "_v")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same keys; the others stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def agreement(a: DataFrame, b: DataFrame, key: str, dims_single: list[str], dims_multi: list[str]) -> DataFrame:
    """``(dim, n, exact, overlap)``: shares of records on which two label sets agree; overlap is the mean Jaccard, two empty sets agreeing."""
    j = a.alias("a").join(b.alias("b"), key)
    rows = []
    for d in dims_single:
        x, y = F.coalesce(F.col(f"a.{d}"), F.lit("")), F.coalesce(F.col(f"b.{d}"), F.lit(""))
        rows.append(F.struct(F.lit(d).alias("dim"), (x == y).cast("double").alias("e"), (x == y).cast("double").alias("o")))
    for d in dims_multi:
        x, y = (F.array_sort(F.array_distinct(F.coalesce(F.col(f"{t}.{d}"), F.array().cast("array<string>")))) for t in "ab")
        u = F.size(F.array_union(x, y))
        rows.append(F.struct(F.lit(d).alias("dim"), (x == y).cast("double").alias("e"), F.when(u == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / u).alias("o")))
    r = j.select(F.explode(F.array(*rows)).alias("r"))
    return r.groupBy(F.col("r.dim").alias("dim")).agg(F.count("*").alias("n"), F.avg("r.e").alias("exact"), F.avg("r.o").alias("overlap"))


def examples(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= k).drop("_rn")


def disagreements(a: DataFrame, b: DataFrame, key: str, dim: str) -> DataFrame:
    """``(key, left, right)`` of the records on which two single-valued label sets differ; a missing label is the empty one."""
    x, y = F.coalesce(F.col("left"), F.lit("")), F.coalesce(F.col("right"), F.lit(""))
    return a.select(key, F.col(dim).alias("left")).join(b.select(key, F.col(dim).alias("right")), key).where(x != y)
