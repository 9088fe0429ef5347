"""Conversations within a budget of characters, for labelers and scorers with a bounded context. Each turn or section first gets an allowance from the lengths alone; one step then shortens whatever is over its allowance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.normalize import sanitize, strip_cot
from siltworks.functions.text import MARKER, fragments, let, segments, truncate, truncate_turns

#: Characters in all; shares of the first request, the last reply and any single turn between; least rest that is worth a piece of a turn.
BUDGET, HEAD, LAST, PER_TURN, WORTH = 20_000, 0.35, 0.30, 0.35, 500
#: Fixed values for scoring: the part of the budget for content, shares of request and reasoning, weights of what is left.
SCORING = {"content": 0.95, "request": 0.15, "cot": 0.45, "prior": 0.20, "trajectory": 0.45, "response": 0.35}
TURNS = "array<struct<from:string,value:string>>"


def chars(ts: Column) -> Column:
    return F.aggregate(ts, F.lit(0), lambda a, t: a + F.length(t["value"]))


def shortened_length(most: Column) -> Column:
    """The length of a longer text cut by :func:`truncate` to ``most``."""
    return F.length(truncate(F.rpad(F.lit("x"), most + 1, F.lit("x")), most))


def middle_allowances(lengths: Column, room: Column, cap: Column) -> Column:
    """For turns of these lengths: ``cap`` each from the last one back while they fit in ``room``; what is left goes to the
    next one if it is worth it; null for those that are left out."""
    state = F.struct(room.alias("room"), F.lit(True).alias("open"), F.array().cast("array<int>").alias("given"))

    def step(s: Column, length: Column) -> Column:
        need = F.when(length <= cap, length).otherwise(shortened_length(cap))
        fits = s["open"] & (need <= s["room"])
        given = F.when(fits, cap).when(s["open"] & (s["room"] > WORTH), s["room"])
        return F.struct(F.when(fits, s["room"] - need).otherwise(s["room"]).alias("room"), fits.alias("open"), F.concat(s["given"], F.array(given)).alias("given"))

    return F.reverse(F.aggregate(F.reverse(lengths), state, step, lambda s: s["given"]))


def _with(ts: Column, most: Column) -> Column:
    """Turns with an allowance each, as (from, value, most)."""
    return F.transform(ts, lambda t: t.withField("most", most))


def within(ts: Column, budget: int = BUDGET, head: float = HEAD, last: float = LAST, per_turn: float = PER_TURN) -> Column:
    """Struct (turns, truncated): the turns without training marks, within ``budget`` characters.

    Leading system turns go first, in order. Of what is left for the others, a single turn has all; of two, the reply has
    0.6; of more, the first request has the share ``head``, the last reply ``last``, and the turns between are filled from
    the end backwards, each with at most ``per_turn``; a note stands for those left out. Null turns are empty."""
    def shorten(ts: Column) -> Column:
        return F.transform(ts, lambda t: F.struct(t["from"].alias("from"), truncate(t["value"], t["most"]).alias("value")))

    def share(x: Column) -> Column:
        """Allowances in the order of the result; ``x`` has the turns after the leading system turns and the budget left."""
        ts, left = x["ts"], x["left"]
        part = lambda r: F.floor(left * r).cast("int")
        two = F.transform(ts, lambda t: t.withField("most", F.when(t["from"] == "gpt", left - part(0.4)).otherwise(part(0.4))))
        at = lambda who: F.filter(F.transform(ts, lambda t, i: F.when(t["from"] == who, i)), lambda i: i.isNotNull())
        first, final = F.coalesce(F.array_min(at("human")), F.lit(0)), F.coalesce(F.array_max(at("gpt")), F.size(ts) - 1)

        def many(e: Column) -> Column:
            middle = F.filter(ts, lambda t, i: (i != e["first"]) & (i != e["final"]))
            given = middle_allowances(F.transform(middle, lambda t: F.length(t["value"])), left - part(head) - part(last), part(per_turn))
            kept = F.filter(F.zip_with(middle, given, lambda t, m: t.withField("most", m)), lambda t: t["most"].isNotNull())
            gone = F.size(middle) - F.size(kept)
            note = F.concat(F.lit("[... "), gone.cast("string"), F.lit(" middle turns omitted for labeling ...]"))
            notes = F.when(gone > 0, F.array(F.struct(F.lit("system").alias("from"), note.alias("value"), F.length(note).alias("most")))).otherwise(F.array())
            edge = lambda k, r: _with(F.array(F.element_at(ts, e[k] + 1)), part(r))
            return F.concat(edge("first", head), notes, kept, edge("final", last))

        most = "array<struct<from:string,value:string,most:int>>"
        whole = _with(ts, F.greatest(left, F.lit(0)))
        return F.when((chars(ts) <= left) | (F.size(ts) <= 1), whole.cast(most)).when(F.size(ts) == 2, two.cast(most)).otherwise(let(F.struct(first.alias("first"), final.alias("final")), many).cast(most))

    def over(ts: Column) -> Column:
        lead = F.coalesce(F.array_min(F.filter(F.transform(ts, lambda t, i: F.when(t["from"] != "system", i)), lambda i: i.isNotNull())), F.size(ts))
        system = F.slice(ts, 1, lead)
        left = F.greatest(F.lit(budget) - chars(system), F.lit(0))
        rest = F.when(left > 0, F.slice(ts, lead + 1, F.greatest(F.size(ts), F.lit(1)))).otherwise(F.array().cast(TURNS))
        return F.concat(truncate_turns(system, budget), let(F.struct(rest.alias("ts"), left.alias("left")), lambda x: shorten(share(x))))

    clean = F.transform(F.coalesce(ts, F.array().cast(TURNS)), lambda t: F.struct(t["from"].alias("from"), sanitize(F.coalesce(t["value"], F.lit(""))).alias("value")))
    return let(clean, lambda c: F.when(chars(c) <= budget, F.struct(c.alias("turns"), F.lit(False).alias("truncated"))).otherwise(F.struct(over(c).alias("turns"), F.lit(True).alias("truncated"))))


def within_budget(df: DataFrame, key: str, turns: str = "turns", budget: int = BUDGET) -> DataFrame:
    """``(key, turns, truncated)`` by :func:`within`."""
    return df.select(key, within(F.col(turns), budget).alias("_w")).select(key, "_w.*")


def within_scoring(ts: Column, mode: Column, cot: Column, budget: int = BUDGET, n: int = 3) -> Column:
    """What a scorer sees of a slice: struct (prior, request, trajectory, cot, response, truncated, original lengths).

    The request has a share of its own, in slow mode the reasoning too; prior turns, trajectory and response share what is
    left by weight among those that there are, the last of them taking the remainder. Null reasoning is none; in fast mode
    cot is null."""
    content = int(budget * SCORING["content"])
    ask = int(content * SCORING["request"])

    def parts(s: Column) -> Column:
        slow = (mode == "slow") & (F.coalesce(cot, F.lit("")) != "")
        response = F.when(mode == "fast", s["response"]).otherwise(strip_cot(s["response"]))
        text = {"prior": sanitize(s["prior"]), "request": sanitize(s["request"]), "trajectory": sanitize(s["trajectory"]), "cot": F.when(slow, sanitize(cot)).otherwise(""), "response": sanitize(response)}
        return F.struct(*[v.alias(k) for k, v in text.items()], s["n_trajectory"].alias("n_trajectory"), s["n_tools"].alias("n_tools"))

    def result(p: Column) -> Column:
        lengths = {k: F.length(p[k]) for k in ("prior", "request", "trajectory", "cot", "response")}
        over = sum(lengths.values(), F.lit(0)) > content
        cot_room = F.when(p["cot"] != "", int(content * SCORING["cot"])).otherwise(0)
        room = content - ask - cot_room
        weight = {k: F.when(p[k] != "", SCORING[k]).otherwise(0.0) for k in ("prior", "trajectory", "response")}
        total = weight["prior"] + weight["trajectory"] + weight["response"]
        floor = lambda k: F.floor(room * (weight[k] / total)).cast("int")
        prior = F.when((weight["trajectory"] == 0) & (weight["response"] == 0), room).otherwise(floor("prior"))
        trajectory = F.when(weight["response"] == 0, room - F.when(weight["prior"] > 0, floor("prior")).otherwise(0)).otherwise(floor("trajectory"))
        reply = room - F.when(weight["prior"] > 0, floor("prior")).otherwise(0) - F.when(weight["trajectory"] > 0, floor("trajectory")).otherwise(0)
        cut = {
            "prior": F.when(p["prior"] != "", truncate(p["prior"], prior, 0.15)).otherwise(""), "request": truncate(p["request"], ask),
            "trajectory": F.when(p["trajectory"] != "", fragments(p["trajectory"], trajectory, n, 0.25, 0.35)).otherwise(""),
            "cot": F.when(p["cot"] != "", fragments(p["cot"], cot_room, n)).otherwise(""),
            "response": F.when(p["response"] == "", "").when(mode == "fast", fragments(p["response"], reply, n, 0.45, 0.25)).otherwise(truncate(p["response"], reply)),
        }
        kept = {k: F.when(over, cut[k]).otherwise(p[k]) for k in cut}
        kept["cot"] = F.when((mode == "slow") & ((kept["cot"] != "") | ~over), kept["cot"])
        return F.struct(*[v.alias(k) for k, v in kept.items()], over.alias("truncated"), *[v.alias(f"{k}_chars") for k, v in lengths.items()], p["n_trajectory"].alias("n_trajectory"), p["n_tools"].alias("n_tools"))

    return let(let(segments(ts, prior=True), parts), result)


__all__ = ["MARKER", "chars", "within", "within_budget", "within_scoring"]
