"""From conversations to training slices and windows: one row per assistant reply, or per stretch of a long conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import WINDOWS
from siltworks.functions.normalize import cot_text, strip_cot, turns
from siltworks.functions.text import let


def reply_positions(ts: Column) -> Column:
    """1-based places of the assistant's replies."""
    return F.filter(F.transform(ts, lambda t, i: F.when(t["from"] == "gpt", i + 1)), lambda x: x.isNotNull())


def slices(df: DataFrame, id_col: str = "id", turns_col: str = "turns") -> DataFrame:
    """One prefix per assistant reply; a conversation with at most one reply comes out whole. All columns of ``df`` are
    kept; added: slice_id, turn_index, total_turns, slice (the turns) and the reply's own reasoning as cot. Null or empty
    turns give one row with an empty slice."""
    ts = F.coalesce(F.col(turns_col), F.array().cast("array<struct<from:string,value:string>>"))
    at = reply_positions(ts)
    ends = F.when(F.size(at) <= 1, F.array(F.size(ts))).otherwise(at)
    out = df.select("*", F.size(ends).alias("total_turns"), F.posexplode(ends).alias("_i", "_end"))
    cut = F.slice(ts, 1, F.col("_end"))
    own = F.when(F.col("_end") > 0, F.element_at(ts, F.greatest(F.col("_end"), F.lit(1))))
    cot = F.when(own["from"] == "gpt", cot_text(own["value"])).otherwise("")
    sid = F.when(F.col("total_turns") > 1, F.concat(F.col(id_col), F.lit("_t"), (F.col("_i") + 1).cast("string"))).otherwise(F.col(id_col))
    clean = F.transform(cut, lambda t: F.struct(t["from"].alias("from"), F.when(t["from"] == "gpt", strip_cot(t["value"])).otherwise(t["value"]).alias("value")))
    return out.select(*df.columns, sid.alias("slice_id"), (F.col("_i") + 1).alias("turn_index"), "total_turns", clean.alias("slice"), cot.alias("cot"))


def current_turns(ts: Column) -> Column:
    """Of each slice of a conversation only its own part: from the request that its reply answers to the reply, without
    reasoning blocks. An array of slices, so the text before the request isn't repeated in every one."""
    clean = F.transform(ts, lambda t: F.struct(t["from"].alias("from"), F.when(t["from"] == "gpt", strip_cot(t["value"])).otherwise(t["value"]).alias("value")))

    def parts(x: Column) -> Column:
        asked = F.filter(F.transform(x, lambda t, i: F.when(t["from"] == "human", i + 1)), lambda p: p.isNotNull())

        def part(end: Column) -> Column:
            ask = F.coalesce(F.array_max(F.filter(asked, lambda p: p < end)), F.greatest(end - 1, F.lit(1)))
            return F.slice(x, ask, end - ask + 1)

        return F.transform(reply_positions(x), part)

    return let(clean, parts)


def trajectory_object(ts: Column) -> Column:
    """Exactly one reply, at least five turns, at least two of them tool turns."""
    n = lambda r: F.size(F.filter(ts, lambda t: t["from"] == r))
    return (n("gpt") == 1) & (F.size(ts) >= 5) & (n("tool") >= 2)


def whole_rows_limit(df: DataFrame, limit: int, order: list[str], n_col: str = "n_slices") -> DataFrame:
    """Rows, in order, while their slices together stay within ``limit``; the first row is always kept.

    The running sum is taken in two steps, within ranges of the order and over the ranges' totals, so no task sees all rows.
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    totals = parts.groupBy("_part").agg(F.sum(n_col).alias("_s"), F.count("*").alias("_c"))
    before = totals.select("_part", F.coalesce(F.sum("_s").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rows"))
    w = Window.partitionBy("_part").orderBy(*order)
    run = parts.join(F.broadcast(before), "_part").withColumn("_cum", F.col("_before") + F.sum(n_col).over(w)).withColumn("_rn", F.col("_rows") + F.row_number().over(w))
    return run.where((F.col("_cum") <= limit) | (F.col("_rn") == 1)).select(*df.columns, F.col("_cum").alias("cum_slices"))


def _index(roles: Column, wanted: tuple[str, ...], lo: Column, hi: Column) -> Column:
    """0-based places in lo..hi whose role is one of ``wanted``."""
    span = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    return F.filter(span, lambda i: F.element_at(roles, i + 1).isin(*wanted))


def body_start(roles: Column, most: int = WINDOWS["prefix"]) -> Column:
    """Where the body begins: after the leading system turns (at most ``most``), the first human turn and the first reply
    after it, with all turns between them; without any of these, after the first ``most`` turns."""
    n = F.size(roles)

    def after(lead: Column) -> Column:
        human = F.try_element_at(_index(roles, ("human",), lead, n - 1), F.lit(1))
        return let(human, lambda h: of(lead, h))

    def of(lead: Column, human: Column) -> Column:
        gpt = F.try_element_at(_index(roles, ("gpt",), F.coalesce(human, n) + 1, n - 1), F.lit(1))
        kept = F.least(lead, F.lit(most))
        last = F.when((kept < most) & human.isNotNull(), F.when((kept + 1 < most) & gpt.isNotNull(), gpt).otherwise(human)).when(kept > 0, kept - 1).otherwise(F.least(F.lit(most), n) - 1)
        return F.least(last + 1, n)

    return let(F.coalesce(F.array_min(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(roles, i + 1) != "system")), n), after)


def windows(df: DataFrame, turns_col: str = "turns", longer_than: int = WINDOWS["longer_than"], size: int = WINDOWS["size"], stride: int = WINDOWS["stride"], prefix: int = WINDOWS["prefix"]) -> DataFrame:
    """Conversations of more than ``longer_than`` turns as windows of the body, ``size`` turns every ``stride``, begun at a
    human or system turn and ended at a reply or tool turn where there is one; others as one window.

    Added: window_index (from 1), total_windows, turn_start, turn_end (0-based, inclusive), prefix_turns, body."""
    ts = F.col(turns_col)

    def plan(roles: Column) -> Column:
        n = F.size(roles)

        def aligned(start: Column) -> Column:
            end = F.least(start + size - 1, n - 1)
            s = F.coalesce(F.try_element_at(_index(roles, ("human", "system"), start, end), F.lit(1)), start)
            return let(s, lambda s: F.struct(s.alias("s"), F.coalesce(F.try_element_at(_index(roles, ("gpt", "tool"), s, end), F.lit(-1)), end).alias("e")))

        def until_the_end(r: Column) -> Column:
            reach = F.array_min(F.filter(F.transform(r, lambda x, i: F.when(x["e"] >= n - 1, i)), lambda x: x.isNotNull()))
            return F.array_distinct(F.slice(r, 1, F.coalesce(reach + 1, F.size(r))))

        one = F.array(F.struct(F.lit(0).alias("s"), (n - 1).alias("e")))
        of = lambda b: F.struct(b.alias("b"), F.when((n > longer_than) & (b < n), let(F.transform(F.sequence(b, n - 1, F.lit(stride)), aligned), until_the_end)).otherwise(one).alias("r"))
        return let(F.when(n > longer_than, body_start(roles, prefix)).otherwise(F.lit(0)), of)

    out = df.where(F.size(ts) > 0).withColumn("_p", let(F.transform(ts, lambda t: t["from"]), plan))
    out = out.select(*df.columns, F.col("_p.b").alias("_b"), F.size("_p.r").alias("total_windows"), F.posexplode("_p.r").alias("_i", "_w"))
    body = F.slice(turns_col, F.col("_w.s") + 1, F.col("_w.e") - F.col("_w.s") + 1)
    return out.select(*df.columns, (F.col("_i") + 1).alias("window_index"), "total_windows", F.col("_w.s").alias("turn_start"), F.col("_w.e").alias("turn_end"), F.col("_b").alias("prefix_turns"), body.alias("body"))


def conversations(df: DataFrame) -> DataFrame:
    """``(row_id, id, source_file, turns)`` of a raw table; rows without turns are left out."""
    return df.where(F.size("conversations") > 0).select("row_id", "id", F.col("metadata.source_file").alias("source_file"), turns(F.col("conversations")).alias("turns"))
