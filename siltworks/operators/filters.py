"""Filters with explicit null semantics, the conversation gate, and pruning within conversations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import PRUNE_RATIO
from siltworks.operators.labels import as_arrays


@dataclass
class FilterConfig:
    """Criteria; one that is None or empty is off."""

    value_min: float | None = None
    selection_min: float | None = None
    correctness_min: float | None = None
    include_unscored: bool = False
    exclude_inherited: bool = False
    verify_source: str | None = None
    thinking_mode: str | None = None
    difficulty: tuple[str, ...] = ()
    include_tags: tuple[str, ...] = ()
    exclude_tags: tuple[str, ...] = ()
    conversation: dict[str, float] = field(default_factory=dict)


def has_tag(labels: Column, tag: str) -> Column:
    """``dim:tag`` in its dimension, or a bare tag in any."""
    a = as_arrays(labels)
    dim, _, t = tag.rpartition(":")
    return F.array_contains(a[dim], t) if dim else F.exists(F.array(*[a[d] for d in ("intent", "difficulty", "context", "language", "domain", "task", "concept", "agentic", "constraint")]), lambda x: F.array_contains(x, t))


def matches(c: FilterConfig) -> Column:
    """All criteria at once, over columns value_score, selection_score, correctness, labels, inherited, partial, source_file, thinking_mode, difficulty.

    A null score fails its minimum unless include_unscored; a null value score fails whenever a score criterion is set; a
    null correctness passes; empty thinking mode, difficulty and source pass; missing labels fail include_tags."""
    yes, no = F.lit(True), F.lit(False)
    out = ~F.coalesce("partial", no)
    if c.exclude_inherited:
        out &= ~F.coalesce("inherited", no)
    if c.verify_source:
        out &= F.coalesce((F.col("source_file") == "") | (F.col("source_file") == c.verify_source), yes)
    if (c.value_min is not None or c.selection_min is not None) and not c.include_unscored:
        out &= F.col("value_score").isNotNull()
    for col, least in (("value_score", c.value_min), ("selection_score", c.selection_min)):
        if least is not None:
            out &= F.coalesce(F.col(col) >= least, F.lit(c.include_unscored))
    if c.correctness_min is not None:
        out &= F.coalesce(F.col("correctness") >= c.correctness_min, yes)
    if c.thinking_mode:
        out &= F.coalesce((F.col("thinking_mode") == "") | (F.col("thinking_mode") == c.thinking_mode), yes)
    if c.difficulty:
        out &= F.coalesce((F.col("difficulty") == "") | F.col("difficulty").isin(*c.difficulty), yes)
    if c.include_tags:
        hit = no
        for t in c.include_tags:
            hit |= has_tag(F.col("labels"), t)
        out &= F.coalesce(hit, no)
    for t in c.exclude_tags:
        out &= ~F.coalesce(has_tag(F.col("labels"), t), no)
    return out


def conversation_criteria(least: dict[str, float]) -> Column:
    """Every threshold reached; a null fails."""
    out = F.lit(True)
    for col, t in least.items():
        out &= F.coalesce(F.col(col) >= t, F.lit(False))
    return out


def prune_turns(df: DataFrame, key: str, order: list[str], value: str, passes: Column, ratio: float = PRUNE_RATIO) -> DataFrame:
    """Of each conversation's failing slices, at most floor(n * ratio) go, the lowest value first (null lowest; of equal ones
    the later first); the first and last slice stay. A single slice stays as it is."""
    w = Window.partitionBy(key)
    x = df.withColumn("_n", F.count("*").over(w)).withColumn("_p", F.row_number().over(w.orderBy(*order)))
    x = x.withColumn("_f", ~F.coalesce(passes, F.lit(False)) & (F.col("_p") > 1) & (F.col("_p") < F.col("_n")))
    x = x.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_f").orderBy(F.col(value).asc_nulls_first(), F.col("_p").desc())))
    return x.where(~F.col("_f") | (F.col("_r") > F.floor(F.col("_n") * F.lit(ratio)))).drop("_n", "_p", "_f", "_r")
