"""Vectorised tokens of a batch of texts: one pass over all code points, no loop over words.

A token is a run of letters and digits, or one CJK character. Its id is a 64-bit hash of its lower-case form.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_P = np.uint64(0x5851F42D4C957F2D)
_PINV = np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))
_tables: dict[str, np.ndarray] = {}
WORD, CJK = 1, 2


def classes() -> np.ndarray:
    """By code point: 0 between tokens, WORD for letters and digits, CJK for characters that are tokens alone."""
    if "class" not in _tables:
        t = np.zeros(0x110000, np.uint8)
        t[[i for i in range(0x20000) if not 0xD800 <= i < 0xE000 and chr(i).isalnum()]] = WORD
        for a, b in ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF), (0x3040, 0x30FF)):
            t[a : b + 1] = CJK
        _tables["class"] = t
    return _tables["class"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Tokens:
    """``h`` token hashes, ``doc`` the text of each, ``start`` and ``end`` places in ``code``; ``base`` where texts begin."""

    h: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    base: np.ndarray
    cls: np.ndarray


def tokenize(texts: list[str]) -> Tokens:
    """Tokens of ``texts``, whole; null counts as empty. Lower-casing may change a text's length, so places are in the lower-case text."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("\0".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in low])]).astype(np.int64)
    if not len(code):
        code = np.zeros(1, np.uint32)
    cls = classes()[code]
    word = cls == WORD
    before = np.concatenate([[False], word[:-1]])
    starts = np.nonzero((word & ~before) | (cls == CJK))[0]
    after = np.concatenate([word[1:], [False]])
    ends = np.nonzero((word & ~after) | (cls == CJK))[0] + 1
    power = np.empty(len(code), np.uint64)
    power[0] = 1
    power[1:] = _P
    inverse = np.empty(len(code), np.uint64)
    inverse[0] = 1
    inverse[1:] = _PINV
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
    h = mix((total[ends] - total[starts]) * inverse[starts])
    doc = np.searchsorted(base, starts, side="right") - 1
    return Tokens(h, doc.astype(np.int64), starts, ends, code, base, cls)


def shingles(h: np.ndarray, group: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k tokens in a row within one group, and the place of the first; groups of fewer than k tokens give
    one shingle of all their tokens."""
    n = len(h)
    if not n:
        return h[:0], np.zeros(0, np.int64)
    out = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        out = out * _P + h[j : n - k + 1 + j] if n >= k else out
    ok = group[: n - k + 1] == group[k - 1 :] if n >= k else np.zeros(0, bool)
    at = np.nonzero(ok)[0]
    first = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
    length = np.diff(np.concatenate([first, [n]]))
    short = first[length < k]
    hs = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        more = length[length < k] > j
        hs[more] = hs[more] * _P + h[short[more] + j] + np.uint64(j + 1)
    h2, at2 = np.concatenate([out[at], hs]), np.concatenate([at, short])
    order = np.argsort(at2, kind="stable")
    return mix(h2[order]), at2[order]
