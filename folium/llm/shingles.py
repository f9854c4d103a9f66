"""Word n-gram hashing over whole Arrow batches, without a Python loop per word.

A batch of texts becomes one array of code points; words are the maximal runs
of letters and decimal digits (Unicode classes L* and Nd).  Each word gets a
64-bit polynomial hash by prefix sums, each n-gram a mixed hash of its words.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (wraps silently on uint64)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    word = np.zeros(0x110000, dtype=bool)
    for cp in range(0x110000):
        k = unicodedata.category(chr(cp))
        word[cp] = k[0] == "L" or k == "Nd"
    code = mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(_BASE))
    return word, code


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, _INV, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text), in text order."""
    joined = "\n".join(texts).lower()
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(cp) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word, code = _classes()
    edge = np.diff(np.concatenate(([0], word[cp].view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(1 << max(16, int(len(cp)).bit_length()))
    total = np.zeros(len(cp) + 1, dtype=np.uint64)
    np.cumsum(code[cp] * up[: len(cp)], out=total[1:])
    h = mix((total[end] - total[start]) * down[start])
    # lower() may change a text's length, so the limits come from the lowered parts
    size = np.fromiter((len(t.lower()) for t in texts), dtype=np.int64, count=len(texts))
    limit = np.cumsum(size + 1)
    if limit[-1] - 1 != len(cp):  # a context-dependent lower case over a border: hash text by text
        parts = [word_hashes([t]) for t in texts]
        return np.concatenate([p[0] for p in parts]), np.repeat(np.arange(len(texts)), [len(p[0]) for p in parts])
    return h, np.searchsorted(limit, start, side="right")


def _chunks(texts: list[str], chars: int):
    """Slices of a batch of about so many characters, so that arrays stay in the CPU's cache."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= chars or i - start >= 60_000:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


#: Bits of a word's hash that name its slot in counts of words.
WORD_BITS = 16


def gram_sets(texts: list[str], n: int, chars: int = 1 << 17, level: np.ndarray | None = None, tally: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text as 48-bit hashes: (hashes, offsets, words of each text).

    Text i owns hashes[offsets[i]:offsets[i + 1]], in ascending order.  With
    levels of commonness per word slot, the upper 16 bits of a hash are the slot of
    the gram's rarest word, so that grams around one rare word sort together; the
    lower 32 bits are then the upper 32 of the plain hash.  tally: counts per word
    slot, which all words are added to.
    """
    grams, sizes, words = [], [], []
    for a, b in _chunks(texts, chars):
        h, doc = word_hashes(texts[a:b])
        words.append(np.bincount(doc, minlength=b - a))
        slot = (h >> np.uint64(64 - WORD_BITS)).astype(np.int64) if level is not None or tally is not None else None
        if tally is not None:
            tally += np.bincount(slot, minlength=len(tally))
        m = len(h) - n + 1
        if m < 1:
            sizes.append(np.zeros(b - a, np.int64))
            continue
        g = h[:m].copy()
        for k in range(1, n):
            g = mix(g * _M2 + h[k : k + m])
        own = doc[:m] == doc[n - 1 :]
        if level is None:
            code = g >> np.uint64(16)
        else:
            by = (level[slot].astype(np.uint64) << np.uint64(WORD_BITS)) | slot.astype(np.uint64)
            rare = by[:m].copy()
            for k in range(1, n):
                np.minimum(rare, by[k : k + m], out=rare)
            code = ((rare & np.uint64((1 << WORD_BITS) - 1)) << np.uint64(32)) | (g >> np.uint64(32))
        key = np.sort((doc[:m][own].astype(np.uint64) << np.uint64(48)) | code[own])
        if len(key):
            key = key[np.concatenate(([True], key[1:] != key[:-1]))]
        sizes.append(np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=b - a))
        grams.append(key & np.uint64((1 << 48) - 1))
    offsets = np.concatenate([[0], *sizes]).astype(np.int64).cumsum()
    flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    return flat, offsets, np.concatenate(words) if words else np.empty(0, np.int64)
