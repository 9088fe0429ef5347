"""Readers of chat records: JSON lines, JSON arrays and Parquet, by file or folder, with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.normalize import detect_format, openai_turns, pseudo_multiturn, strip_pangu, system_turns, turns

TURNS = T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))
MESSAGES = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("role", "content", "reasoning_content", "thinking_content", "cot_content")]))
RAW = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("data", MESSAGES), T.StructField("conversations", TURNS), T.StructField("messages", MESSAGES),
    T.StructField("meta_prompt", T.ArrayType(T.StringType())), T.StructField("tools", T.StringType()), T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
CORRUPT = "_corrupt_record"


def discover(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("jsonl", "json", "parquet")) -> DataFrame:
    """``(path, folder, stem, kind)`` of the data files under ``path``; of siblings with one stem, JSON lines win. System files (``._*``, dot files) are left out."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, it = [], fs.listFiles(root, True)
    while it.hasNext():
        p = it.next().getPath()
        name = p.getName()
        stem, _, kind = name.rpartition(".")
        if kind in kinds and not name.startswith((".", "_")) and stem:
            found.append((p.toString(), p.getParent().toString(), stem, kind))
    df = spark.createDataFrame(found, "path string, folder string, stem string, kind string")
    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    return df.withColumn("_r", F.row_number().over(Window.partitionBy("folder", "stem").orderBy(order))).where("_r = 1").drop("_r")  # a listing


def read_records(spark: SparkSession, paths: list[str] | str, schema: T.StructType = RAW, multi_line: bool = False) -> DataFrame:
    """JSON records with ``source_file`` and the broken ones' text in ``_corrupt_record``; nothing is inferred."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).option("recursiveFileLookup", True).json(paths)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_any(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """All data files under ``path``, of either format, by one schema; unknown columns are left out, missing ones null."""
    files = discover(spark, path).collect()  # a listing
    parts = []
    for kind, multi in (("jsonl", False), ("json", True)):
        own = [f.path for f in files if f.kind == kind]
        if own:
            parts.append(read_records(spark, own, schema, multi))
    own = [f.path for f in files if f.kind == "parquet"]
    if own:
        pq = spark.read.parquet(*own).withColumn("source_file", F.col("_metadata.file_path"))
        parts.append(pq.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in pq.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], "source_file"))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("source_file", T.StringType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def parse_stats(df: DataFrame) -> DataFrame:
    """``(source_file, rows, broken)`` of records read by :func:`read_records`."""
    return df.groupBy("source_file").agg(F.count("*").alias("rows"), F.count(CORRUPT).alias("broken"))


def normalise(df: DataFrame) -> DataFrame:
    """Any of the three turn sources as ``turns``, with ``original_format`` and ``is_pseudo_multiturn``; data before conversations before messages."""
    kind = detect_format(F.col("data"), F.col("conversations"), F.col("messages"))
    pangu = F.concat(system_turns(F.col("meta_prompt")), F.transform(openai_turns(F.col("data")), lambda t: F.struct(t["from"].alias("from"), strip_pangu(t["value"]).alias("value"))))
    ts = F.when(kind == "pangu", pangu).when(kind == "sharegpt", turns(F.col("conversations"))).when(kind == "openai_messages", openai_turns(F.col("messages"))).otherwise(F.array().cast(TURNS))
    pseudo = F.coalesce(F.exists("data", lambda t: F.lower(t["role"]).isin("user", "human") & F.contains(t["content"], F.lit("[unused10]"))), F.lit(False))
    return df.withColumn("turns", ts).withColumn("original_format", kind).withColumn("is_pseudo_multiturn", pseudo & (kind == "pangu"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a hash of the key: the same at each run."""
    return df.orderBy(_draw(key, seed), key).limit(n)


def _draw(key: str, seed: int) -> Column:
    """A hash of the key and seed that other engines give too."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratified_sample(df: DataFrame, key: str, stratum: str, n: int, least: int = 3, seed: int = 42) -> DataFrame:
    """max(least, n / strata) rows of each stratum by hash of the key, then others by hash until there are ``n``."""
    k = df.select(stratum).distinct().count()
    per = max(least, n // max(k, 1))
    ranked = df.withColumn("_h", _draw(key, seed)).withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key)))
    return ranked.orderBy(F.col("_r") > per, "_h", key).limit(n).drop("_h", "_r")


def serialize_tool_calls(calls: Column) -> Column:
    """Tool calls (name, arguments) as tagged text, one a line."""
    return F.array_join(F.transform(calls, lambda c: F.concat(F.lit("<tool_call>"), F.to_json(F.struct(c["name"].alias("name"), c["arguments"].alias("arguments"))), F.lit("</tool_call>"))), "\n")


def probe(df: DataFrame) -> DataFrame:
    """``(category, n)``: which turn format records have."""
    return df.groupBy(detect_format(F.col("data"), F.col("conversations"), F.col("messages")).alias("category")).agg(F.count("*").alias("n"))


__all__ = ["discover", "normalise", "parse_stats", "probe", "pseudo_multiturn", "read_any", "read_records", "seeded_sample", "serialize_tool_calls", "stratified_sample"]
