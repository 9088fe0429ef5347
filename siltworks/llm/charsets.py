"""Problem 9: texts read in a wrong character encoding, and what they were before.

Near-twins on text stripped of non-ASCII characters. The unit of the twin join is the word: of all words with the same
ASCII skeleton ("pr\\0fung") the most frequent spelling is clean, the others may be garbled twins; where one of the others stands more than a
fifth as often, either may be the clean one, and a decoding of utf-8 decides. Aligned run by run they
give pairs (garbled, clean), and each pair votes for the wrong decodings that explain it. Decodings with enough votes are
the learned mappings; together with those between scripts that no ASCII skeleton can witness (checked by the corpus's own
character pairs) they are applied to every run of non-ASCII characters of every document. Where a decoding lost characters,
the clean twin gives them back if there is one. A sequence that stands alone, which may be what the text speaks of, counts
if it too has a twin: a clean character between the same words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from math import log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.session import cut, written

RUN = re.compile(r"[^\x00-\x7f]+")
WIDE = frozenset(("gb18030", "big5", "cp932", "euc_kr"))
_UTF8 = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
#: Codecs as Python names them: bytes of ``RIGHT`` read as ``WRONG``.
WRONG = ("cp1252", "latin-1", "cp1250", "iso8859_2", "cp1251", "cp437", "cp850", "mac_roman", "gb18030", "koi8_r", "cp866", "big5", "cp932", "euc_kr", "iso8859_15", "cp1254", "mac_cyrillic", "cp1257", "cp1253", "iso8859_5")
RIGHT = ("utf-8", "gb18030", "cp1251", "koi8_r", "cp1252", "cp866", "big5", "cp932", "mac_roman", "cp437", "cp850", "euc_kr", "cp1250")
#: Decodings between scripts without ASCII letters: no skeleton witnesses them, character pairs do.
UNWITNESSED = tuple((w, r) for w, r in product(WRONG, RIGHT) if r in ("gb18030", "cp1251", "koi8_r", "big5", "cp932", "euc_kr", "cp866") and w in ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250")) + (("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("koi8_r", "utf-8"), ("cp866", "utf-8"), ("big5", "utf-8"), ("cp932", "utf-8"), ("euc_kr", "utf-8"), ("big5", "gb18030"), ("gb18030", "big5"))
LOST = "�"
_BEFORE, _AFTER = re.compile(r"(\w+)\W*$", re.ASCII), re.compile(r"\W*(\w+)", re.ASCII)
LONE = 4  # characters of a sequence that may stand alone as the subject of a sentence


def to_bytes(s: str, codec: str) -> bytes | None:
    """The bytes of ``s``; where a single-byte codec leaves bytes undefined, C1 controls stand for themselves."""
    try:
        return s.encode(codec)
    except UnicodeEncodeError:
        if codec in ("utf-8", "gb18030", "big5", "cp932", "euc_kr"):
            return None
    out = bytearray()
    for ch in s:
        try:
            out += ch.encode(codec)
        except UnicodeEncodeError:
            if not 0x80 <= ord(ch) <= 0x9F:
                return None
            out.append(ord(ch))
    return bytes(out)


def undo(s: str, wrong: str, right: str) -> str | None:
    """``s`` as it was before bytes of ``right`` were read as ``wrong``; None if it can't have been so."""
    b = to_bytes(s, wrong)
    try:
        got = b.decode(right) if b else None
    except UnicodeDecodeError:
        return None
    return got if got and got != s else None


@lru_cache(100_000)
def forward(s: str, wrong: str, right: str) -> frozenset[str]:
    """What ``s`` may become when its ``right`` bytes are read as ``wrong``: exactly, with losses marked, or with losses left out."""
    try:
        b = s.encode(right)
    except UnicodeEncodeError:
        return frozenset()
    out = {b.decode(wrong, how) for how in ("replace", "ignore")}
    out.add("".join(c for c in bytes(b).decode(wrong, "ignore") if c.isprintable() and c != "\xad"))
    if wrong.startswith("cp"):
        out.add("".join(bytes([x]).decode(wrong, "ignore") or chr(x) for x in b))
    return frozenset(out - {s, ""})


def _census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words with non-ASCII characters by skeleton, of characters and of character pairs; flushed in bounded parts."""
    words: Counter = Counter()
    chars: Counter = Counter()
    duos: Counter = Counter()
    lone: Counter = Counter()

    def flush() -> pa.RecordBatch:
        rows = [("w", RUN.sub("\0", w), w, n) for w, n in words.items()] + [("x", c, r, n) for (c, r), n in lone.items()] + [("c", c, "", n) for c, n in chars.items()] + [("p", p, "", n) for p, n in duos.items()]
        words.clear(), chars.clear(), duos.clear(), lone.clear()
        k, a, b, n = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(a), pa.array(b), pa.array(n, pa.int64())], names=["kind", "a", "b", "n"])

    for batch in batches:
        for t in batch.column(0).to_pylist():
            runs = []
            for m in RUN.finditer(t):
                runs.append(m.group())
                if m.end() - m.start() <= LONE and alone(t, m.start(), m.end()):
                    lone[context(t, m.start(), m.end()), m.group()] += 1
            words.update(w for w in _words(t) if sum(map(str.isascii, w)) >= 2)
            for r in runs:
                chars.update(r)
                duos.update(map("".join, zip(r, r[1:], strict=False)))
        if len(words) + len(duos) + len(lone) > 200_000:
            yield flush()
    if words or chars:
        yield flush()


def alone(t: str, a: int, b: int) -> bool:
    """No letter, digit or underscore touches ``t[a:b]``."""
    return not ((a and (t[a - 1].isalnum() or t[a - 1] == "_")) or (b < len(t) and (t[b].isalnum() or t[b] == "_")))


def context(t: str, a: int, b: int) -> str:
    """The words before and after ``t[a:b]`` on its line, with a gap for what stands between: the skeleton of a sequence that stands alone."""
    before = _BEFORE.search(t, max(t.rfind("\n", 0, a) + 1, a - 60), a)
    end = t.find("\n", b)
    after = _AFTER.match(t, b, min(end if end >= 0 else len(t), b + 60))
    return f"{before.group(1).lower() if before else ''}\0{after.group(1).lower() if after else ''}"


_LETTER = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CORE = re.compile(r"[^\x00-\x7f]+(?:[A-Za-z]+[^\x00-\x7f]+)*[A-Za-z]*")


def _spans(t: str) -> Iterator[tuple[int, int]]:
    """Where the words with non-ASCII characters stand: letters and non-ASCII characters without a gap."""
    for m in _CORE.finditer(t):
        a = m.start()
        while a and t[a - 1] in _LETTER:
            a -= 1
        yield a, m.end()


def _words(t: str) -> list[str]:
    return [t[a:b] for a, b in _spans(t)]


def _votes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each (garbled, clean) pair of words, the decodings that explain all runs that differ."""
    for f in frames:
        out = []
        for word, clean, rare in zip(f["word"], f["clean"], f["rare"], strict=True):
            for x, y in zip(RUN.findall(word), RUN.findall(clean), strict=True):
                if x == y:
                    continue
                for w, r in product(WRONG, RIGHT if rare else ("utf-8",)):
                    if w != r and undo(x, w, r) == y:
                        out.append((w, r, x, y))
        yield pd.DataFrame(out, columns=["wrong", "right", "garbled", "clean"])


class Mender:
    """Finds and undoes wrong decodings in a text, with learned decodings and the corpus's character statistics."""

    def __init__(self, learned: list[tuple[str, str]], chars: dict[str, int], duos: dict[str, int], leads: frozenset[str] = frozenset()) -> None:
        self.learned, self.chars, self.duos = learned, chars, duos
        self.wide, self.narrow = [p for p in learned if p[0] in WIDE], [p for p in learned if p[0] not in WIDE]
        self.plain = [p for p in self.narrow if p[1] != "utf-8"]  # no sequence of characters tells where these stand
        self.extra_wide, self.extra_narrow = [p for p in UNWITNESSED if p[0] in WIDE], [p for p in UNWITNESSED if p[0] not in WIDE]
        self.leads = leads
        table = [(w, "".join(re.escape(bytes([x]).decode(w, "ignore") or chr(x)) for x in range(0xC2, 0xF5)), "".join(re.escape(bytes([x]).decode(w, "ignore") or chr(x)) for x in range(0x80, 0xC0))) for w, r in learned if r == "utf-8" and w not in WIDE]
        self.sequence = re.compile("|".join(f"[{a}][{b}]" for _, a, b in table) or "(?!)")
        self.memo: dict[tuple[str, bool], tuple[str | None, bool]] = {}
        self.total = sum(chars.values()) or 1

    def score(self, s: str) -> float:
        """Mean log frequency of the characters and pairs of ``s``."""
        x = [log(1 + self.chars.get(c, 0)) for c in s] + [log(1 + self.duos.get(a + b, 0)) for a, b in zip(s, s[1:], strict=False) if not (a + b).isascii()]
        return sum(x) / max(len(x), 1)

    def known(self, s: str) -> bool:
        """All characters are in use in the corpus and none is a control, private or unassigned one."""
        return all(c.isascii() or (self.chars.get(c, 0) >= 2 and (c.isprintable() or c in "\xa0 \xad​‍ ")) for c in s)

    def run(self, r: str, inside: bool) -> tuple[str | None, bool]:
        """The text that the run ``r`` was, or None, and whether losses stay. ``inside``: it touches an ASCII letter."""
        key = (r, inside)
        if key not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            got, rest = self._run(r, inside), False
            if got is None and len(r) > 1 and (LOST in r or (max(r) <= "\u2fff" and self.sequence.search(r))):
                got, rest = self.parts(r)
            self.memo[key] = got, rest
        return self.memo[key]

    def _run(self, r: str, inside: bool, depth: int = 0) -> str | None:
        wide = max(r) > "\u2fff" and not max(r) == LOST
        best, high, at = None, 0.0, None
        witnessed = self.wide if wide else self.narrow if self.sequence.search(r) else self.plain
        for w, right in witnessed:
            got = undo(r, w, right)
            if got is None:
                continue
            again = self._run(got, inside, depth + 1) if depth < 2 and not got.isascii() else None
            got = again or got
            if not self.known(got) or (got.isascii() and len(r) < 2):
                continue
            at = self.score(r) if at is None else at
            own = self.score(got)
            if right == "utf-8" and wide:
                ok = (inside or len(r) > 1) and (own > at or (inside and len(got) <= 3))
            elif right == "utf-8":
                ok = len(r) > len(got)
            else:
                ok = own > at + 2 and (len(r) > 3 or (inside and len(r) <= 2))
            if ok and (best is None or own > high):
                best, high = got, own
        if best is None and len(r) >= 4 and depth == 0:
            for w, right in self.extra_wide if wide else self.extra_narrow:
                got = undo(r, w, right)
                if got and not got.isascii() and self.known(got):
                    at = self.score(r) if at is None else at
                    own = self.score(got)
                    if own > max(at + 1.5, 3) and own > high and self.uniform(got):
                        best, high = got, own
        return best

    @staticmethod
    def uniform(s: str) -> bool:
        """One script, in the letter case that words have."""
        cyr = sum("Ѐ" <= c <= "ӿ" for c in s)
        cjk = sum("　" <= c <= "鿿" or "＀" <= c <= "￯" or "가" <= c <= "힯" for c in s)
        if cyr > cjk:
            return cyr >= 0.7 * len(s) and sum(c.isupper() for c in s) <= 1 + 0.2 * len(s)
        return cjk >= 0.9 * len(s)

    def mend(self, t: str) -> tuple[bool, str, list[str], list[str]]:
        """Whether ``t`` has a garbled sequence, ``t`` with what decodings give back, words with losses left in it, and the
        contexts of garbled sequences that stand alone: these may be what the text speaks of, so they alone prove nothing."""
        out, last, bad, left, lone = [], 0, False, [], []
        for m in RUN.finditer(t):
            a, b, r = m.start(), m.end(), m.group()
            inside = (a > 0 and t[a - 1] in _LETTER) or (b < len(t) and t[b] in _LETTER)
            got, rest = self.run(r, inside)
            if got is None and not self.lossy(r):
                if inside and not self.leads.isdisjoint(r):
                    left.append(self.word_at(t, a, b))
                continue
            if len(r) <= LONE and alone(t, a, b):
                lone.append(context(t, a, b))
            else:
                bad = True
            if got is None or rest or LOST in got:
                left.append(self.word_at(t, a, b))
            if got is not None:
                out += [t[last:a], got]
                last = b
        return bad, "".join([*out, t[last:]]), left, lone

    @staticmethod
    def lossy(r: str) -> bool:
        return LOST in r or any("\x80" <= c <= "\x9f" for c in r)

    def parts(self, r: str) -> tuple[str | None, bool]:
        """A run of which only parts are garbled, or that has losses: what can be given back, and whether losses stay."""
        if LOST in r and max(r.replace(LOST, "") or "a") > "\u2fff":  # wide: pieces between losses, less a broken character at an end
            out = []
            for piece in r.split(LOST):
                got = next((g for p in ((piece, "", ""), (piece[1:], piece[:1], ""), (piece[:-1], "", piece[-1:])) for w, x in self.wide if p[0] and x == "utf-8" and (g := undo(p[0], w, x)) and self.known(g) and (len(g) > 1 or len(piece) == 1)), None)
                out.append(piece if got is None else got)
            done = LOST.join(out)
            return (done, True) if done != r else (None, True)
        found = None
        for w, x in self.narrow:
            if x != "utf-8":
                continue
            b = bytearray()
            for ch in r:  # one byte a character, so places agree; what the codec doesn't have ends a sequence
                one = to_bytes(ch, w)
                b.append(one[0] if one and len(one) == 1 else 0)
            out, last = [], 0
            for m in _UTF8.finditer(b):
                got = m.group().decode("utf-8", "replace")
                if self.known(got):
                    out += [r[last : m.start()], got]
                    last = m.end()
            if last and (found is None or self.score("".join([*out, r[last:]])) > self.score(found)):
                found = "".join([*out, r[last:]])
        return found, LOST in r

    @staticmethod
    def word_at(t: str, a: int, b: int) -> str:
        while a and (t[a - 1] in _LETTER or not t[a - 1].isascii()):
            a -= 1
        while b < len(t) and (t[b] in _LETTER or not t[b].isascii()):
            b += 1
        return t[a:b]


def learn(docs: DataFrame, clean_min: int = 3, votes_min: int = 2) -> tuple[list[tuple[str, str]], dict[str, int], dict[str, int], DataFrame, DataFrame]:
    """Learned decodings (wrong, right), best first; counts of characters and of pairs; twins (word, clean, explained); and
    what stands alone in each context (context, run).

    Decodings are bounded by the codec tables. Counts are whole: as many as there are characters and pairs in the corpus.
    ``rare`` twins stand at most a fifth as often as the clean spelling; of the others single-byte decodings prove nothing,
    as words of one language may differ by these, so only utf-8 explains them.
    """
    census = docs.where(F.col("text").rlike(r"[^\x00-\x7F]")).select("text").mapInArrow(_census, "kind string, a string, b string, n long")
    census = written(census.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")), "census")
    words = census.where("kind = 'w'")
    top = words.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("clean"), F.max("n").alias("most")).where(F.col("most") >= clean_min)
    both = words.join(top, "a").where("b <> clean").withColumn("rare", F.expr("n * 5 <= most"))
    twins = both.select(F.col("b").alias("word"), "clean", "rare", F.col("most").alias("m"), F.lit(False).alias("turned"))
    twins = twins.union(both.where(~F.col("rare") & (F.col("n") >= clean_min)).select(F.col("clean").alias("word"), F.col("b").alias("clean"), "rare", F.col("n").alias("m"), F.lit(True).alias("turned")))
    twins = cut(twins.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word"))
    votes = twins.mapInPandas(_votes, "wrong string, right string, garbled string, clean string")
    got = votes.groupBy("wrong", "right").agg(F.countDistinct("garbled", "clean").alias("n")).where(F.col("n") >= votes_min).collect()
    learned = [(r.wrong, r.right) for r in sorted(got, key=lambda r: (-r.n, r.wrong, r.right))]
    counts = [{r.a: r.n for r in census.where(F.col("kind") == k).select("a", "n").collect()} for k in ("c", "p")]
    return learned, counts[0], counts[1], twins, census.where("kind = 'x'").select(F.col("a").alias("context"), F.col("b").alias("run"))


def _explained(learned: list[tuple[str, str]]):  # noqa: ANN202
    utf8 = [p for p in learned if p[1] == "utf-8"]
    pairs = utf8 + [p for p in learned if p[1] != "utf-8"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = []
            for word, clean, rare, turned in zip(f["word"], f["clean"], f["rare"], f["turned"], strict=True):
                xs, ys = RUN.findall(word), RUN.findall(clean)
                use = pairs if rare else utf8
                # losses turn dashes and dots into letters, so a more frequent spelling is lossy only if the other has letters
                ok.append(all(x == y or (LOST in x and LOST not in y) or any(undo(x, *p) == y or (x in forward(y, *p) and (y.isalpha() or not turned)) for p in use) for x, y in zip(xs, ys, strict=True)))
            yield f[ok][["word", "clean", "m"]]

    return run


def wrong_encoding(df: DataFrame) -> DataFrame:
    """``(doc_id, restored, whole)`` of every document with a garbled sequence: the text with what could be given back, and
    whether nothing is known to be missing.

    ``df`` has doc_id and text. Null, empty and ASCII-only texts are never garbled; repeated texts each come out; a text
    that only quotes garbled characters as its subject is left out: a garbled sequence that stands alone counts if the
    words around it stand around a clean character somewhere in the corpus. Empty tables give no rows.
    """
    docs = df.select("doc_id", "text")
    learned, chars, duos, twins, lone = learn(docs)
    known = twins.mapInPandas(_explained(learned), "word string, clean string, m long")
    known = cut(known.groupBy("word").agg(F.max_by("clean", F.struct("m", "clean")).alias("clean")))
    spelt = known.select(F.explode(F.array_distinct(F.split(F.regexp_replace("word", r"[\x00-\x7F]", ""), ""))).alias("c")).distinct().collect()  # characters, so bounded
    leads = frozenset(r.c for r in spelt)

    def clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Mender(learned, chars, duos, leads)
        for f in frames:
            yield f[[m.run(r, False)[0] is None and not m.lossy(r) for r in f["run"]]][["context"]]

    witnesses = cut(lone.mapInPandas(clean, "context string").distinct())  # contexts in which a clean character stands somewhere

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Mender(learned, chars, duos, leads)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                bad, text, left, at = m.mend(t)
                if bad or left or at:
                    rows.append((i, bad, text if bad or at else None, left, at))
            ids, bads, texts, lefts, ats = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bads, pa.bool_()), pa.array(texts, pa.string()), pa.array(lefts, strings), pa.array(ats, strings)], names=["doc_id", "bad", "text", "words", "contexts"])

    seen = docs.where(F.col("text").rlike(r"[^\x00-\x7F]")).mapInArrow(mend, "doc_id long, bad boolean, text string, words array<string>, contexts array<string>")
    seen = written(seen.withColumn("rid", F.monotonically_increasing_id()), "mended")
    proven = seen.where("not bad").select("rid", F.explode(F.array_distinct("contexts")).alias("context")).join(witnesses, "context", "left_semi").select("rid").distinct().withColumn("proven", F.lit(True))
    hits = seen.select("rid", F.explode(F.array_distinct("words")).alias("word")).join(known, "word").groupBy("rid").agg(F.collect_list(F.struct("word", "clean")).alias("fix"))
    lost = seen.where("text is null").join(hits, "rid", "left_semi").select("doc_id", "rid").join(docs, "doc_id").select("rid", F.col("text").alias("raw"))
    out = seen.join(hits, "rid", "left").join(lost, "rid", "left").join(proven, "rid", "left").where("bad or fix is not null or proven").withColumn("text", F.coalesce("text", "raw"))
    fixed = F.aggregate(F.coalesce("fix", F.array().cast("array<struct<word:string,clean:string>>")), F.col("text"), lambda acc, x: F.replace(acc, x["word"], x["clean"]))
    out = out.select("doc_id", fixed.alias("restored"))
    return out.select("doc_id", "restored", (~F.contains("restored", F.lit(LOST))).alias("whole"))
