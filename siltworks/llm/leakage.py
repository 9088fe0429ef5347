"""Problem 8: documents that hold the text of held-out items, wholly or in part.

Distributed positional inverted index. Terms are GRAM tokens in a row (all tokens of a shorter item); one pass over the corpus posts (term, document,
positions) for the terms that items have. Document frequencies come from the index itself. Per item the lists are met from
the rarest term on: a passage with the wanted share of an item holds so many of its terms that it can't avoid the rarest
1 - skip of them, so the most frequent lists aren't needed to find candidates. For candidates all lists are intersected by
offset: hits at nearly one offset (position minus item position) chain into passages; the best passage, or the best two near
each other, decide.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tokens import mix, tokenize
from siltworks.session import cut, written

GRAM = 4
SHARE = 0.27  # a third of an item's tokens, less what a few changed words take from the chain
SKIP = 0.15
SLACK = 4  # tokens by which the offset may move within a passage
GAP = 12  # tokens between two hits of a passage
BLOCK_TERMS = 500_000  # terms of the items that are looked for in one pass; more items take more passes
_ESCAPES = re.compile(r"\\u([0-9a-fA-F]{4})|\\[ntr]|\\")


def plain(t: str | None) -> str:
    """``t`` without escaping: JSON escapes and HTML entities as the characters they stand for."""
    if not t:
        return ""
    if "\\" in t:
        t = _ESCAPES.sub(lambda m: (chr(int(m.group(1), 16)) if not "d800" <= m.group(1).lower() < "e000" else " ") if m.group(1) else " ", t)
    return html.unescape(t) if "&" in t and ";" in t else t


def _terms(texts: list[str], lengths: tuple[int, ...] = (GRAM,)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term hashes of so many tokens, the text and the token place of each; token counts of the texts."""
    t = tokenize([plain(x) for x in texts])
    n = np.bincount(t.doc, minlength=len(texts)) if len(t.h) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    hs, docs, places = [], [], []
    for k in lengths:
        if len(t.h) < k:
            continue
        h = t.h[: len(t.h) - k + 1].copy()
        for j in range(1, k):
            h = mix(h + np.uint64(j)) + t.h[j : len(t.h) - k + 1 + j]
        ok = np.nonzero(t.doc[: len(t.h) - k + 1] == t.doc[k - 1 :])[0]
        hs.append(mix(h[ok] + np.uint64(k)).view(np.int64)), docs.append(t.doc[ok]), places.append(ok - first[t.doc[ok]])
    none = np.zeros(0, np.int64)
    return np.concatenate(hs or [none]), np.concatenate(docs or [none]), np.concatenate(places or [none]), n


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of items; one of fewer than GRAM tokens has one term of all its tokens."""
    for b in batches:
        h, doc, pos, n = _terms(b.column(1).to_pylist(), tuple(range(1, GRAM + 1)))
        ids, size = b.column(0).to_numpy(), _sizes_of(doc, pos, n)
        keep = size == np.minimum(n[doc], GRAM)
        h, doc, pos, size = h[keep], doc[keep], pos[keep], size[keep]
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids[doc]), pa.array(pos.astype(np.int32)), pa.array(n[doc].astype(np.int32)), pa.array(size.astype(np.int32))], names=["term", "item_id", "j", "n", "size"])


def _sizes_of(doc: np.ndarray, pos: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The number of tokens of each of :func:`_terms` of the lengths 1 to GRAM, which come one length after the other."""
    total, out, at = n.sum(), np.zeros(len(doc), np.int64), 0
    for k in range(1, GRAM + 1):
        many = int(np.maximum(n - k + 1, 0).sum()) if total else 0
        out[at : at + many] = k
        at += many
    return out


def _index(wanted: np.ndarray, lengths: tuple[int, ...]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                h, doc, pos, _ = _terms(part.column(1).to_pylist(), lengths)
                at = np.minimum(np.searchsorted(wanted, h), max(len(wanted) - 1, 0))
                keep = wanted[at] == h if len(wanted) else np.zeros(len(h), bool)
                h, doc, pos = h[keep], doc[keep], pos[keep]
                order = np.lexsort((pos, h, doc))
                h, doc, pos = h[order], doc[order], pos[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, bool)
                start = np.nonzero(new)[0]
                ids = part.column(0).to_numpy()
                lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(h)).astype(np.int32)), pa.array(pos.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(h[start]), pa.array(ids[doc[start]]), lists], names=["term", "doc_id", "ps"])

    return run


def passages(hits: list[tuple[int, int]], gram: int = GRAM) -> list[tuple[int, int, set[int]]]:
    """Chains of hits (position, item position): (first position, last position, item tokens covered)."""
    done, open_ = [], []
    for p, j in sorted(hits):
        keep = []
        for c in open_:
            (keep if p - c[1] <= GAP else done).append(c)
        open_ = keep
        best = None
        for c in open_:
            move = abs((p - j) - (c[1] - c[2]))
            if c[2] < j and move <= SLACK and (best is None or (move, -len(c[3])) < (best[0], -len(best[1][3]))):
                best = (move, c)
        if best:
            c = best[1]
            c[1], c[2] = p, j
            c[3].update(range(j, j + gram))
        else:
            open_.append([p, p, j, set(range(j, j + gram))])
    return [(c[0], c[1], c[3]) for c in done + open_]


def coverage(hits: list[tuple[int, int]], n: int, gram: int = GRAM) -> float:
    """The share of an item's ``n`` tokens in the best passage, or in the best two near each other."""
    found = sorted(passages(hits, gram), key=lambda c: c[:2])
    best = max((len(c[2]) for c in found), default=0)
    open_: list[tuple[int, int, set[int]]] = []  # those whose end is near enough to where the next one begins
    for b in found:
        if len(b[2]) < max(6, 0.08 * n):
            continue
        open_ = [a for a in open_ if b[0] - a[1] <= max(30, n // 2)]
        for a in open_:
            if len(a[2]) + len(b[2]) > best:
                best = max(best, len(a[2] | b[2]))
        open_.append(b)
    return min(1.0, best / max(n, 1))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs, items, shares = [], [], []
        for d, i, n, hits in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            docs.append(d), items.append(i), shares.append(coverage([(p, h["j"]) for h in hits for p in h["ps"]], n))
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(shares, pa.float64())], names=["doc_id", "item_id", "share"])


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE, skip: float = SKIP) -> DataFrame:
    """``(doc_id, item_id, share)`` of every document that holds at least ``share`` of an item's tokens as a passage or two.

    ``documents`` has doc_id and text, ``items`` item_id and text. Null and empty texts on either side hold and leak
    nothing; items of fewer than GRAM tokens are found wherever all their tokens stand together. Repeated documents and items
    all come out. Empty tables give no rows.

    Items are taken in blocks of about BLOCK_TERMS terms, each looked for in all documents, so what a worker holds is bounded.
    """
    terms = cut(items.where(F.col("text").isNotNull()).select("item_id", "text").mapInArrow(_item_terms, "term long, item_id long, j int, n int, size int"))
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    out = None
    for k in range(blocks):
        found = _leaks_of(documents, terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else terms, share, skip)
        out = found if out is None else out.unionByName(found)
    return out


def _leaks_of(documents: DataFrame, terms: DataFrame, share: float, skip: float) -> DataFrame:
    """:func:`leaks` of a block of items."""
    held = terms.select("term", "size").distinct().toPandas()  # a block's terms
    wanted, lengths = np.unique(held["term"].to_numpy(np.int64)), tuple(sorted({GRAM, *held["size"].tolist()}))
    index = written(documents.where(F.length("text") > 0).select("doc_id", "text").mapInArrow(_index(wanted, lengths), "term long, doc_id long, ps array<int>"), "index")
    freq = index.groupBy("term").agg(F.count("*").alias("df"))
    ranked = terms.join(freq, "term").groupBy("item_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "j", "term"))).alias("ts"))  # an item's own terms
    rare = ranked.select("item_id", "n", F.explode(F.slice("ts", 1, F.greatest(F.lit(1), F.ceil(F.size("ts") * (1 - skip)).cast("int")))).alias("t")).select("item_id", "n", F.col("t.term").alias("term"), F.col("t.j").alias("j"))
    rare = cut(rare)
    met = index.select("term", "doc_id").join(F.broadcast(rare), "term").groupBy("doc_id", "item_id", "n").agg(F.count_distinct("j").alias("k"))  # a block's terms
    # of a passage with the wanted share, at least so many term starts are among the rare ones: half are lost to changed words
    candidates = cut(met.where(F.col("k") >= F.greatest(F.lit(1), F.floor(F.col("n") * F.lit((share - skip) / 2)))).select("doc_id", "item_id", "n"))
    wide = terms.select("term", "item_id", "j")
    hits = index.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi").join(F.broadcast(wide), "term").join(candidates, ["doc_id", "item_id"])
    grouped = hits.groupBy("doc_id", "item_id", "n").agg(F.collect_list(F.struct("j", "ps")).alias("hits"), F.count_distinct("j").alias("k"))  # one document's hits of one item
    grouped = grouped.where(F.col("k") + GRAM - 1 >= F.col("n") * F.lit(share / 2)).select("doc_id", "item_id", "n", "hits")
    return grouped.mapInArrow(_judge, "doc_id long, item_id long, share double").where(F.col("share") >= share)
