"""Writers. All go through Spark's committers, so a lost executor leaves no half-written result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None, keep_nulls: bool = True, per_file: int = 0) -> None:
    """JSON lines; ``by`` mirrors a folder tree and replaces only the folders written (dynamic overwrite)."""
    w = df.write.mode(mode).option("ignoreNullFields", not keep_nulls)
    if per_file:
        w = w.option("maxRecordsPerFile", per_file)
    if by:
        w = w.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    w.json(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    w = df.write.mode(mode).option("compression", "zstd")
    (w.partitionBy(*by).option("partitionOverwriteMode", "dynamic") if by else w).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Review sheets; list columns joined by commas, a byte-order mark before the first heading."""
    flat = [F.array_join(c, ", ").alias(c) if t.startswith("array<string>") else F.col(c) for c, t in df.dtypes]
    first = df.columns[0]
    df.select(*flat).withColumnRenamed(first, "﻿" + first).write.mode(mode).option("header", True).option("sep", sep).option("quoteAll", True).csv(path)


def training_form(record_id: Column, ts: Column) -> Column:
    """A record stripped to id and conversations."""
    return F.struct(record_id.alias("id"), ts.alias("conversations"))


def fold_back(rows: DataFrame, slices: DataFrame, key: str, order: str, fields: list[str], into: str = "turns_scored") -> DataFrame:
    """Scored slices as one array on their row, in order; rows without slices get an empty one."""
    entry = F.struct(order, *fields)
    per = slices.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias(into))
    return rows.join(per, key, "left").withColumn(into, F.coalesce(into, F.array().cast(per.schema[into].dataType)))
