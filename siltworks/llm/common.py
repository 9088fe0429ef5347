"""What the training-data operators share: record choice, tag spelling, role spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm_tag(c: Column) -> Column:
    """A tag without blanks and tabs around it, in lower case, each run of white space and underscores as one hyphen."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")), r"(?U)[\s_]+", "-")


def norm_role(c: Column) -> Column:
    """The role in its usual spelling: human, gpt, tool or system; others as they are, in lower case."""
    r = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)


def latest(df: DataFrame, columns: list, key: str = "id") -> DataFrame:
    """One row per ``key``: that with the latest ``ingested_at``, the larger ``row_id`` if equal; ``columns`` are kept.

    Partial aggregation runs before the shuffle, so a key with a third of all rows sends one row per input partition.
    A null key is a record of its own; a null ``ingested_at`` is the earliest.
    """
    keep = F.struct(*[c if isinstance(c, Column) else F.col(c) for c in columns]).alias("_kept")
    k = F.coalesce(F.concat(F.lit("i"), F.col(key)), F.concat(F.lit("r"), F.col("row_id").cast("string"))).alias("_key")
    rows = df.select(k, F.struct("ingested_at", "row_id").alias("_at"), keep)
    return rows.groupBy("_key").agg(F.max_by("_kept", "_at").alias("_kept")).select("_kept.*")
