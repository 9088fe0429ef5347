"""Column functions that bring heterogeneous chat records into turns of {from, value}, and their reasoning blocks apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TURN = "struct<from:string,value:string>"
#: Fixed patterns of the record formats.
PANGU_COT = r"(?s)\[unused16\].*?\[unused17\]"
PANGU_TOKENS = r"\[unused(?:9|1[0-7])\]"
NO_THINK = r"\s*/no_think"
THINK = r"(?s)<(?:think|thinking)>.*?</(?:think|thinking)>"
TRAINING_TAGS = ("solution", "tool_call", "tool_response", "issue", "patch", "code_change", "file_change", "original_code", "new_code", "bug_fixes", "tests", "diff", "hunk", "context", "change", "fix", "command", "output", "result", "reasoning", "response")


def role(c: Column) -> Column:
    """human, gpt, tool or system; other roles in lower case; null as the empty role."""
    r = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(r.isin("user", "human"), "human").when(r.isin("assistant", "gpt"), "gpt").otherwise(r)


def turns(c: Column) -> Column:
    """Turns with roles in their usual spelling and null values as empty ones; null turns stay null."""
    return F.transform(c, lambda t: F.struct(role(t["from"]).alias("from"), F.coalesce(t["value"], F.lit("")).alias("value")))


def detect_format(data: Column, conversations: Column, messages: Column) -> Column:
    """Which of the three turn sources routes the record; the first non-empty wins, in this order."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    return F.when(some(data), "pangu").when(some(conversations), "sharegpt").when(some(messages), "openai_messages").otherwise("unknown")


def strip(c: Column) -> Column:
    """``c`` without white space around it."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_cot(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, PANGU_COT, ""), THINK, ""))


def cot_text(c: Column) -> Column:
    """The reasoning blocks of one reply, tagged ones first, joined by blank lines."""
    tagged = F.transform(F.regexp_extract_all(c, F.lit(THINK), 0), lambda m: strip(F.regexp_replace(F.regexp_replace(m, "^<(?:think|thinking)>", ""), "</(?:think|thinking)>$", "")))
    tokens = F.transform(F.regexp_extract_all(c, F.lit(PANGU_COT), 0), lambda m: strip(F.regexp_replace(m, r"\[unused1[67]\]", "")))
    return F.array_join(F.filter(F.concat(tagged, tokens), lambda x: x != ""), "\n\n")


def strip_pangu(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip_cot(c), NO_THINK, ""), PANGU_TOKENS, ""))


def sanitize(c: Column) -> Column:
    """Without training tags (their content stays) and fenced reasoning blocks."""
    tags = "|".join(TRAINING_TAGS)
    return F.regexp_replace(F.regexp_replace(c, rf"(?i)</?(?:{tags})(?:\s[^>]*)?>", ""), r"(?is)```(?:COT|REASONING|THINKING)\b.*?```", "")


def thinking_mode(ts: Column) -> Column:
    """slow if any turn holds a reasoning marker, else fast."""
    return F.when(F.exists(ts, lambda t: t["value"].rlike(THINK) | t["value"].rlike(PANGU_COT)), "slow").otherwise("fast")


def system_turns(meta_prompt: Column) -> Column:
    """A list of leading prompts as system turns; blank ones are left out."""
    kept = F.filter(F.transform(F.coalesce(meta_prompt, F.array().cast("array<string>")), strip), lambda x: x != "")
    return F.transform(kept, lambda x: F.struct(F.lit("system").alias("from"), x.alias("value")))


def openai_turns(messages: Column) -> Column:
    """role/content messages as turns; the first non-blank reasoning field goes before the reply as a think block's text."""
    return F.transform(messages, lambda m: F.struct(role(m["role"]).alias("from"), F.coalesce(m["content"], F.lit("")).alias("value")))


def pseudo_multiturn(ts: Column) -> Column:
    """One user and one assistant turn with separators: the training form of a multi-turn conversation."""
    body = F.filter(ts, lambda t: t["from"] != "system")
    last = F.element_at(body, -1)
    lead = F.slice(body, 1, F.greatest(F.size(body) - 1, F.lit(0)))
    text = F.array_join(F.transform(lead, lambda t: t["value"]), "[unused10][unused9]")
    return F.when(F.size(body) > 0, F.array(F.struct(F.lit("human").alias("from"), text.alias("value")), F.struct(last["from"].alias("from"), last["value"].alias("value")))).otherwise(F.array().cast(f"array<{TURN}>"))


def conversation_uid(record_id: Column, ts: Column, source_file: Column | None = None, source_row: Column | None = None) -> Column:
    """A stable id: the hash of the record as JSON with sorted keys."""
    fields = [record_id.alias("id")]
    if source_file is not None:
        fields.append(source_file.alias("source_file"))
    if source_row is not None:
        fields.append(source_row.cast("long").alias("source_row"))
    fields.append(ts.alias("turns"))
    js = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return F.concat(F.lit("conversation_uid:v1:"), F.substring(F.sha2(js, 256), 1, 24))


def data_id(meta_prompt: Column, data: Column) -> Column:
    return F.sha2(F.to_json(F.struct(data.alias("data"), meta_prompt.alias("meta_prompt")), {"ignoreNullFields": "false"}), 256)


def turn_id(did: Column, turn: Column) -> Column:
    return F.concat(F.lit("tid:v1:"), F.substring(F.sha2(F.concat_ws("#", did, turn.cast("string")), 256), 1, 20))


def think_to_tokens(c: Column) -> Column:
    """Think tags as token pairs; empty blocks are removed."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)<think>\s*</think>", ""), r"(?s)<think>\s*(.*?)\s*</think>", "[unused16]$1[unused17]")


def conversation_cot(ts: Column) -> Column:
    """The reasoning of all replies, in order, joined by blank lines."""
    own = F.transform(F.filter(ts, lambda t: t["from"] == "gpt"), lambda t: cot_text(t["value"]))
    return F.array_join(F.filter(own, lambda x: x != ""), "\n\n")


def chat_form(record_id: Column, ts: Column, fallback: Column) -> Column:
    """Struct (id, conversations): a record as plain chat, with a made id where it has none."""
    return F.struct(F.coalesce(F.nullif(record_id, F.lit("")), fallback).alias("id"), ts.alias("conversations"))


def token_form(record_id: Column, ts: Column, fallback: Column) -> Column:
    """Struct (id, data): a record as role and content, with reasoning as token pairs."""
    names = lambda r: F.when(r == "human", "user").when(r == "gpt", "assistant").otherwise(r)
    data = F.transform(ts, lambda t: F.struct(names(t["from"]).alias("role"), F.when(t["from"] == "gpt", think_to_tokens(t["value"])).otherwise(t["value"]).alias("content")))
    return F.struct(F.coalesce(F.nullif(record_id, F.lit("")), fallback).alias("id"), data.alias("data"))
