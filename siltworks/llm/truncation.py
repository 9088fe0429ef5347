"""Problem 5: text values that stop before their end.

What decides is learnt from the corpus itself, in one pass over all values:

* the vocabulary trie: a table of its nodes (every proper prefix of the vocabulary's words, with the uses below it), so it
  is built and searched by joins and never held whole. A value whose last token is no known word but a proper prefix of
  known words stops within a word (``prefix``);
* length evidence: a length at which several values of one source stop early by other evidence, and at least half of its
  unclosed values do, is a field limit; every other unclosed value of that length was cut there too (``limit``);
* sentence-end shares. A value is closed if a final mark stands at its end. Values of one kind (role, how the last line
  opens, whether it holds a closed sentence already, whether lines stand before it) close nearly always or don't (kinds too
  rare to tell are taken without the role, then without the script): where they do, an unclosed one stops within a sentence (``sentence``). Where a kind doesn't tell (list items, logs, casual lines), a
  last word that practically never ends a sentence or line anywhere in the corpus does (``word``);
* what needs no corpus: open fences, tags, back quotes and brackets (``open``).

No list of words, log formats or languages is built in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import norm_role
from siltworks.llm.tokens import CJK, tokenize
from siltworks.session import written

KNOWN_MIN = 3  # uses that make a word known
END_SHARE, END_USES = 0.004, 30  # a word that ends sentences or lines in less than this share of at least so many uses is no end
CLOSE_SHARE, CLOSE_USES = 0.9, 30  # a kind of value of which at least this share of at least so many is closed
LIMIT_USES, LIMIT_SHARE = 3, 0.5  # a length at which so many values of a source stop early, and this share of its unclosed values
SALTS = 16  # parts into which the values that end in one word are cut
NUMBER = "#"
ENDS = ".?!。？！؟।"
CLOSERS = "\"'”’»)]}）】」』*_`"
INVISIBLE = "​‌‍⁠﻿­\x00"
_BLANK = "".join(chr(i) for i in range(0x3001) if chr(i).isspace()) + INVISIBLE
_DOTS = re.compile(r"(?:…|\.\.\.+)[\s" + INVISIBLE + r"\"'”’»」』*_]*$")
_ITEM = re.compile(r"(?:[-*+•]|\d+[.)])\s+")
_INNER = re.compile(r"[.?!][\"'”’»)\]]*\s+\S|[。？！]\S")
_PAST = _BLANK + "`\"'”’»)]*_,;:-–—"  # what may stand after the last word
_PAIRS = ("()", "[]", "{}")


def _wide(c: str) -> bool:
    return "㐀" <= c <= "鿿" or "豈" <= c <= "﫿"


def _lead(c: str) -> str:
    return "C" if _wide(c) else "U" if c.isupper() else "l" if c.islower() else NUMBER if c.isdigit() else c


@dataclass
class Form:
    """What the form of a value says: its ``kind``; without the role, ``family``; without the script too, ``stock``; whether it is closed or left open; its last word."""

    kind: str
    family: str
    stock: str
    closed: bool
    open: bool
    word: str


def form(v: str | None, role: str = "") -> Form | None:
    """The form of a value; None if nothing is in it or after its last closing fence or tag."""
    s = (v or "").rstrip(_BLANK)
    if not s:
        return None
    low = s.lower()
    think, call = low.rfind("</think>"), s.rfind("</tool_call>")
    if low.rfind("<think>") > think or s.rfind("<tool_call>") > call or s.count("```") % 2:
        return Form("", "", "", False, True, _last_word(s))
    block = s[max(s.rfind("```") + 3 if "```" in s else 0, think + 8 if think >= 0 else 0, call + 12 if call >= 0 else 0) :].strip()
    if not block:
        return None
    at = block.rfind("\n") + 1
    last = block[at:].lstrip()
    item = _ITEM.match(last)
    body = last[item.end() :] if item else last
    lead = _lead(body[:1] or " ")
    around = f"{'item' if item else 'line'} %s {'closed' if _INNER.search(last[:-1]) else 'first'} {'later' if at else 'only'}"
    family = around % lead
    dots = _DOTS.search(s) if "…" in s or "..." in s else None
    core = s.rstrip(CLOSERS + " ")
    closed = not dots and core[-1:] != "" and core[-1] in ENDS
    whole = block if block[0] in "{[" else last
    left = last.count("`") % 2 == 1 or any(whole.count(a) > whole.count(b) for a, b in _PAIRS)
    return Form(f"{role} {family}", family, around % ("S" if lead in "CU" else lead), closed, left, _last_word(s[: dots.start()] if dots else s))


def _last_word(s: str) -> str:
    s = s[-400:].rstrip(_PAST)
    at = len(s)
    while at and s[at - 1].isalnum():
        at -= 1
    w = s[at:]
    return "" if not w or _wide(w[-1]) else NUMBER if any(c.isdigit() for c in w) else w.lower()


def turns(df: DataFrame) -> DataFrame:
    """``(row_id, turn_pos, source_file, role, value)`` of every turn with a value."""
    t = df.select("row_id", F.col("metadata.source_file").alias("source_file"), F.posexplode("conversations").alias("turn_pos", "t"))
    return t.select("row_id", "turn_pos", "source_file", norm_role(F.col("t.from")).alias("role"), F.col("t.value").alias("value"))


_CLOSE = np.array(sorted(map(ord, CLOSERS)), np.uint32)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part of the input: each word but values' last ones, its uses, and its uses at the end of a sentence or line (closing quotes and brackets may stand between)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 3000):
            t = tokenize(batch.slice(lo, 3000).column(0).to_pylist())
            if not len(t.h):
                continue
            code = np.append(t.code, [0, 0]).astype(np.uint32)
            past = np.where(np.isin(code, _CLOSE), len(code) - 1, np.arange(len(code)))
            past = np.minimum.accumulate(past[::-1])[::-1]  # the next place without a closing mark
            final = np.append(t.doc[1:] != t.doc[:-1], True)
            letters = t.cls[t.start] != CJK
            digit = np.concatenate([[0], np.cumsum((t.code >= 48) & (t.code <= 57))])
            number = digit[t.end] > digit[t.start]
            after = past[t.end]
            then = code[past[np.minimum(after + 1, len(code) - 1)]]
            end = (np.isin(code[after], [46, 63, 33]) & np.isin(then, [32, 10, 0])) | (code[after] == 10)
            keep = letters & ~final
            h = np.where(number, np.uint64(1), t.h)[keep]
            u, at, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            ended = np.bincount(back, weights=end[keep], minlength=len(u)).astype(np.int64)
            a, b = t.start[keep][at], t.end[keep][at]
            text = t.code.tobytes().decode("utf-32-le", "surrogatepass")
            words = [NUMBER if x == 1 else text[i:j] for x, i, j in zip(u.tolist(), a.tolist(), b.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64)), pa.array(ended)], names=["word", "n", "ended"])


FORMS = "row_id long, turn_pos int, source_file string, kind string, family string, stock string, open boolean, word string, length int, closed long"


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each value that isn't closed or is left open; the closed ones as counts by kind (row_id null), once a task."""
    counts: Counter = Counter()
    for b in batches:
        values = b.column("value").to_pylist()
        got = [form(v, r) for v, r in zip(values, b.column("role").to_pylist(), strict=True)]
        counts.update((f.kind, f.family, f.stock) for f in got if f and f.closed and not f.open)
        keep = [k for k, f in enumerate(got) if f and (f.open or not f.closed)]
        part = b.take(pa.array(keep, pa.int64()))
        own = [got[k] for k in keep]
        yield pa.RecordBatch.from_arrays([
            part.column("row_id"), part.column("turn_pos"), part.column("source_file"), pa.array([f.kind for f in own], pa.string()), pa.array([f.family for f in own], pa.string()), pa.array([f.stock for f in own], pa.string()), pa.array([f.open for f in own], pa.bool_()),
            pa.array([f.word for f in own], pa.string()), pa.array([len(values[k]) for k in keep], pa.int32()), pa.array([0] * len(keep), pa.int64()),
        ], names=["row_id", "turn_pos", "source_file", "kind", "family", "stock", "open", "word", "length", "closed"])
    if counts:
        n = len(counts)
        none = lambda t: pa.array([None] * n, t)
        yield pa.RecordBatch.from_arrays([
            none(pa.int64()), none(pa.int32()), none(pa.string()), *[pa.array([c[i] for c in counts], pa.string()) for i in range(3)], none(pa.bool_()), none(pa.string()), none(pa.int32()), pa.array(list(counts.values()), pa.int64()),
        ], names=["row_id", "turn_pos", "source_file", "kind", "family", "stock", "open", "word", "length", "closed"])


def forms(values: DataFrame) -> DataFrame:
    """Forms of ``(row_id, turn_pos, source_file, role, value)``."""
    return values.select("row_id", "turn_pos", "source_file", "role", "value").mapInArrow(_forms, FORMS)


@dataclass
class Statistics:
    """What the corpus says: ``vocabulary`` (word, n, ended); which kinds, families and stocks of values close nearly always (``closing``, by what they are named by)."""

    vocabulary: DataFrame
    closing: dict[str, DataFrame]


def learn(values: DataFrame, found: DataFrame) -> Statistics:
    """Statistics of all ``values`` (see :func:`turns`), given their forms."""
    vocabulary = values.where(F.length("value") > 0).select("value").mapInArrow(_vocabulary, "word string, n long, ended long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("ended").alias("ended"))
    vocabulary = written(vocabulary.where(F.col("n") >= KNOWN_MIN), "vocabulary")
    own = found.where("not coalesce(open, false)")

    def closing(by: str) -> DataFrame:
        g = own.groupBy(by).agg(F.sum("closed").alias("c"), F.count("row_id").alias("o"))
        return g.where((F.col("c") + F.col("o") >= CLOSE_USES)).select(by, (F.col("c") >= CLOSE_SHARE * (F.col("c") + F.col("o"))).alias(f"{by}_closes"))

    return Statistics(vocabulary, {by: closing(by) for by in ("kind", "family", "stock")})


def word_evidence(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(word, evidence)`` of the distinct ``words`` that are a prefix (unknown, but a node of the trie) or never an end."""
    long_ = vocabulary.where((F.length("word") > 1) & (F.col("word") != NUMBER))
    trie = long_.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", F.lit(1), i))).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("below"))
    j = words.where("word <> ''").select("word").distinct().join(vocabulary, "word", "left").join(trie, "word", "left")
    never = (F.col("n") >= END_USES) & (F.col("ended") < END_SHARE * F.col("n"))
    unknown = F.col("n").isNull() & F.col("below").isNotNull()
    return j.select("word", F.when(unknown, "prefix").when(never, "word").alias("evidence")).where("evidence is not null")


def weighed(found: DataFrame, s: Statistics) -> DataFrame:
    """``(row_id, turn_pos, source_file, length, evidence)`` of forms that are left open or not closed; evidence may be null."""
    own = found.where("row_id is not null").withColumn("salt", F.pmod(F.xxhash64("row_id", "turn_pos"), F.lit(SALTS)))
    w = word_evidence(own, s.vocabulary).withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))  # words with evidence only
    x = own.join(w, ["word", "salt"], "left")
    for by, table in s.closing.items():
        x = x.join(table, by, "left")
    closes = F.coalesce(*[f"{by}_closes" for by in s.closing], F.lit(False))
    why = F.when(F.col("evidence") == "prefix", "prefix").when(~F.col("open") & closes, "sentence").when(F.col("open"), "open").otherwise(F.col("evidence"))
    return x.select("row_id", "turn_pos", "source_file", "length", why.alias("evidence"))


def field_limits(found: DataFrame) -> DataFrame:
    """``(source_file, length, limit)``: lengths at which a source cuts its values, from :func:`weighed` values."""
    g = found.groupBy("source_file", "length").agg(F.count("evidence").alias("m"), F.count("*").alias("n"))
    return g.where((F.col("m") >= LIMIT_USES) & (F.col("m") >= LIMIT_SHARE * F.col("n"))).select("source_file", "length", F.lit(True).alias("limit"))


def judge(found: DataFrame, limits: DataFrame) -> DataFrame:
    """``(row_id, turn_pos, evidence)`` of the weighed values that stop early."""
    same = F.col("x.source_file").eqNullSafe(F.col("y.source_file")) & (F.col("x.length") == F.col("y.length"))
    x = found.alias("x").join(limits.alias("y"), same, "left")
    why = F.when(F.col("evidence") == "prefix", "prefix").when(F.col("limit"), "limit").otherwise(F.col("evidence"))
    return x.select("row_id", "turn_pos", why.alias("evidence")).where("evidence is not null")


def stops(df: DataFrame) -> DataFrame:
    """``(row_id, turn_pos, evidence)`` of every turn whose value stops early. ``df`` has row_id, conversations and metadata.

    Null and empty values don't stop early; null ``source_file`` is a source of its own. Values of any length are read
    whole. Rows delivered again each come out. Empty tables give no rows.
    """
    found = written(forms(turns(df)), "forms")
    open_ = written(weighed(found, learn(turns(df), found)), "weighed")
    return judge(open_, field_limits(open_))


def cut_turns(df: DataFrame) -> DataFrame:
    """``(row_id, turn_pos)`` of :func:`stops`."""
    return stops(df).select("row_id", "turn_pos")


def truncation_by_source(df: DataFrame) -> DataFrame:
    """``(source_file, turns, cut, share)``: of each source, its turns, those that stop early, and their share."""
    t = turns(df).groupBy("source_file").agg(F.count("*").alias("turns"))
    c = cut_turns(df).join(df.select("row_id", F.col("metadata.source_file").alias("source_file")), "row_id").groupBy(F.col("source_file").alias("s")).agg(F.count("*").alias("cut"))
    out = t.join(c, F.col("source_file").eqNullSafe(F.col("s")), "left")
    return out.select("source_file", "turns", F.coalesce("cut", F.lit(0)).alias("cut"), (F.coalesce("cut", F.lit(0)) / F.col("turns")).alias("share"))


__all__ = ["Form", "Statistics", "cut_turns", "form", "field_limits", "forms", "judge", "learn", "stops", "truncation_by_source", "turns", "weighed"]
