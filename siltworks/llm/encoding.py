"""Problem 7: token ids of whole texts by a public byte-level BPE, with reuse of content-defined chunks.

A rolling hash over the bytes chooses chunk ends, so equal passages give equal chunks wherever they stand. Each distinct
chunk is encoded once per Python worker (a bounded cache that outlives tasks). A chunk end inside a pre-token would change
ids, so joins are repaired: where the join isn't at a place at which the tokenizer's pattern always splits, the pieces on
both sides are re-encoded together, from the last safe place before to the first after, until the ids agree with those of
the whole text. Texts never leave their task, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = os.environ.get("SILTWORKS_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Fixed value of the public tokenizer: its pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MASK_BITS = 6
WINDOW = 16
CACHE_CHARS = 32 << 20
_state: dict = {}


def encoder(path: str):  # noqa: ANN201
    """The tokenizer of this worker."""
    if path not in _state:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _state[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _state[path]


def chunk_ends(code: np.ndarray, bits: int = MASK_BITS) -> np.ndarray:
    """Positions after which a chunk may end: where the hash of the last WINDOW code points has ``bits`` zero bits."""
    n = len(code)
    if n <= WINDOW:
        return np.zeros(0, np.int64)
    h = np.zeros(n - WINDOW + 1, np.uint64)
    m = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    m ^= m >> np.uint64(29)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(m, dtype=np.uint64)])
    h = total[WINDOW:] - total[:-WINDOW]  # a sum over the window rolls by one add and one subtract
    h = (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)
    return np.nonzero(h == 0)[0] + WINDOW


def safe_joins(code: np.ndarray, space: np.ndarray) -> np.ndarray:
    """``safe[i]``: the pattern always splits before position i. So it does where white space follows anything else."""
    s = space[np.minimum(code, len(space) - 1)]
    safe = np.zeros(len(code) + 1, bool)
    safe[0] = safe[-1] = True
    safe[1:-1] = s[1:] & ~s[:-1]
    return safe


def _space_table() -> np.ndarray:
    """White space by the regular expressions' ``\\s``: of the Unicode property, not Python's wider list."""
    t = np.zeros(0x3002, bool)
    t[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True
    return t


class Chunks:
    """Encodes texts by way of a bounded cache of chunks."""

    def __init__(self, path: str, bits: int = MASK_BITS, limit: int = CACHE_CHARS) -> None:
        self.encode = encoder(path).encode_ordinary
        self.space, self.bits, self.limit, self.held, self.cache = _space_table(), bits, limit, 0, {}
        self.asked = self.hits = self.repaired = 0

    def piece(self, text: str) -> list[int]:
        self.asked += 1
        got = self.cache.get(text)
        if got is not None:
            self.hits += 1
            return got
        got = self.encode(text)
        self.held += len(text)
        if self.held > self.limit:
            self.cache, self.held = {}, len(text)
        self.cache[text] = got
        return got

    def ids(self, text: str) -> list[int]:
        if not text:
            return []
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = chunk_ends(code, self.bits)
        if not len(ends):
            return self.piece(text)
        safe = np.nonzero(safe_joins(code, self.space))[0]
        # repair: a join at an unsafe place is re-encoded from the safe place before to the one after, which are both joins
        # of their own then; what lies between two safe places is encoded as one, so ids agree with those of the whole text
        at = np.searchsorted(safe, ends)
        hit = safe[np.minimum(at, len(safe) - 1)] == ends
        self.repaired += int((~hit).sum())
        bounds = np.unique(np.concatenate([[0], ends[hit], safe[np.maximum(at[~hit] - 1, 0)], safe[np.minimum(at[~hit], len(safe) - 1)], [len(code)]]))
        out: list[int] = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out += self.piece(text[a:b])
        return out


def encode_corpus(df: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` of every row, by the byte-level BPE in ``vocabulary``, without special tokens.

    Empty and null texts give an empty list; strings of special tokens are ordinary text. Repeated rows come out as often
    as they stand there. Texts of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _state.setdefault(("chunks", vocabulary), None) or Chunks(vocabulary)
        _state["chunks", vocabulary] = chunks
        for b in batches:
            ids, offsets, flat = b.column(0), np.zeros(b.num_rows + 1, np.int32), []
            for i, t in enumerate(b.column(1).to_pylist()):
                flat += chunks.ids(t or "")
                offsets[i + 1] = len(flat)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))], names=[id_col, "ids"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"{id_col} long, ids array<int>")
