"""SuperMinHash signatures of word-shingle sets, vectorised over the documents of a slice.

Each element walks through one random permutation of the signature's places: at step j it
offers the value j + r (r uniform in [0, 1)) to the j-th place of its permutation, and a
place keeps the least offer. As all offers of step j lie in [j, j + 1), a document is done once
its largest place is below the next step: early stopping, after about m log(m) / n steps for n elements.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_BASE, _INVERSE = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64)))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP_BITS = np.uint64(56)  # a value is step << 56 | r in 56 bits

_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit integers."""
    x = (x ^ x >> np.uint64(30)) * _MIX2
    x = (x ^ x >> np.uint64(27)) * _MIX
    return x ^ x >> np.uint64(31)


def shingle_sets(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, offsets by text).

    Words are separated by ASCII white space, A-Z lower-cased. A text of fewer than SHINGLE words, but not
    none, has its whole sequence as its one shingle.
    """
    n, docs = len(raw), len(off) - 1
    if len(_powers[0]) <= n:
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n + n // 8, b)]) for b in (_BASE, _INVERSE)]
    word = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(word & (~np.r_[False, word[:-1]] | edge[:-1])) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(word & (~np.r_[word[1:], False] | edge[1:])) + 1 if n else starts
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=prefix[1:])
    h = mix((prefix[ends] - prefix[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))
    at = np.searchsorted(starts, off)
    m = max(0, len(h) - SHINGLE + 1)
    whole = np.zeros(m, np.uint64)
    for k in range(SHINGLE):
        whole = whole * _MIX + h[k:k + m]
    whole = mix(whole)
    size = np.diff(at)
    parts = []
    for d in range(docs):
        if size[d] >= SHINGLE:
            s = np.sort(whole[at[d]:at[d + 1] - SHINGLE + 1])
            parts.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif size[d]:
            x = np.array([size[d]], np.uint64)
            for w in h[at[d]:at[d + 1]]:
                x = x * _MIX + w
            parts.append(mix(x))
        else:
            parts.append(np.zeros(0, np.uint64))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)


def signatures(elements: np.ndarray, at: np.ndarray, m: int, chunk: int = 1 << 16) -> np.ndarray:
    """[documents, m] signatures; an empty set has the largest value everywhere."""
    docs = len(at) - 1
    out = np.full((docs, m), np.iinfo(np.uint64).max, np.uint64)
    d = 0
    while d < docs:
        # As many documents as make up a chunk of elements; a longer one is its own chunk.
        e = max(d + 1, int(np.searchsorted(at, at[d] + chunk, side="right")) - 1)
        e = min(e, docs)
        _fill(elements[at[d]:at[e]], np.repeat(np.arange(e - d), np.diff(at[d:e + 1])), out[d:e], m)
        d = e
    return out


def _fill(x: np.ndarray, doc: np.ndarray, out: np.ndarray, m: int) -> None:
    """One chunk; ``doc`` is ascending. Elements of finished documents leave after every step."""
    order = np.broadcast_to(np.arange(m, dtype=np.uint16), (len(x), m)).copy() if len(x) else None
    rows = np.arange(len(x))
    flat = out.reshape(-1)
    for j in range(m):
        if not len(rows):
            return
        r = mix(x + np.uint64((j + 1) * int(_MIX) & 0xFFFFFFFFFFFFFFFF))
        # The low 16 bits choose the place among those left, the upper 48 are r.
        k = j + ((r & np.uint64(0xFFFF)) * np.uint64(m - j) >> np.uint64(16)).astype(np.int64)
        place = order[rows, k]
        order[rows, k] = order[rows, j]
        value = np.uint64(j) << _STEP_BITS | r >> np.uint64(8)
        cell = doc * m + place
        # Least offer per cell: a descending sort by value would do too, but `minimum.at` is linear.
        np.minimum.at(flat, cell, value)
        busy = out.max(axis=1) >= np.uint64(j + 1) << _STEP_BITS
        left = busy[doc]
        if not left.all():
            rows, doc, x = rows[left], doc[left], x[left]
