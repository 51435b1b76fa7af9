"""Words of UTF-8 texts as 64-bit hashes, vectorised over bytes, and hashes of word windows.

A word's hash is a polynomial of its bytes modulo 2^64, taken as a difference of
running sums, then mixed with its length. A window's hash is a polynomial of its
words' hashes. Equal sequences have equal hashes; different ones collide with a
chance near 2^-64 a pair.
"""

from __future__ import annotations

import hashlib

import numpy as np

_M = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD1342543DE82EF95)
_BLOCK = 18  # 2^18 bytes: the running sums of a block stay in cache
_POWERS: dict = {}

#: The separators of the word rule [^\x20\x09-\x0D]+.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters and digits and the bytes of other characters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        n = 1 << max(16, int(n - 1).bit_length())
        inv = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))])
                     for b in (base, inv))
        _POWERS[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bounds(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = BLANKS):
    """(start, end, first): byte bounds of every word, and each text's first word (n+1)."""
    inside = ~sep[data]
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    d = offs[(offs > 0) & (offs < n)]
    opens[d] = inside[d]
    closes[d - 1] = inside[d - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(start, offs)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of data[start:end] for each word."""
    out = np.zeros(len(start), np.uint64)
    size = end - start
    giant = size > (1 << _BLOCK)
    stop = np.where(giant, start + 1, end)
    pw, inv = _powers(_M, 2 << _BLOCK)
    cuts = np.flatnonzero(np.diff(start >> _BLOCK)) + 1
    for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(start)]):
        if i == j:
            continue
        lo, hi = start[i], stop[j - 1]
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * pw[:hi - lo], out=run[1:])
        s = start[i:j] - lo
        out[i:j] = (run[stop[i:j] - lo] - run[s]) * inv[s]
    for i in np.flatnonzero(giant):  # a word of over 256 KB
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(out + size.astype(np.uint64) * _Q)


def beginnings(data: np.ndarray, start: np.ndarray, end: np.ndarray, sizes) -> list[np.ndarray]:
    """For each size: the hash of each word's first ``size`` bytes, 0 for shorter words.
    Not equal to the hash of a whole word of those bytes."""
    out = []
    width = max(sizes)
    byte = np.zeros(len(start), np.uint64)
    run = np.zeros(len(start), np.uint64)
    last = len(data) - 1
    for i in range(width):
        byte = data[np.minimum(start + i, last)].astype(np.uint64) if last >= 0 else byte
        run = (run + byte + np.uint64(1)) * _M
        if i + 1 in sizes:
            out.append(np.where(end - start > i, mix(run + np.uint64(i + 1)), np.uint64(0)))
    return out


def words(data, offs, sep=BLANKS, lower: bool = False):
    """(hash, first) of the words of texts; ``first`` has each text's first word and the end."""
    if lower:
        data = LOWER[data]
    start, end, first = bounds(data, offs, sep)
    return hashes(data, start, end), first


def word_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(b, np.zeros(1, np.int64), np.array([len(b)]))[0]) if len(b) else 0


def windows(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each position (also across texts; see ``full``)."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    if seed:
        h = mix(h ^ np.uint64(seed))
    pw, inv = _powers(_Q, n + 1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(h * pw[:n], out=run[1:])
    return mix((run[k:] - run[:-k]) * inv[:n - k + 1])


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def full(first: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each position (as in ``windows``) lie in one text."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, bool)
    last = np.repeat(first[1:], np.diff(first))[:n - k + 1]
    return np.arange(n - k + 1) + k <= last


def sliding(a: np.ndarray, w: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over each w neighbours, by doubling."""
    have = 1
    while have * 2 <= w:
        a = op(a[:-have], a[have:])
        have *= 2
    return op(a[:len(a) - (w - have)], a[w - have:]) if w > have else a


def anchors(g: np.ndarray, ok: np.ndarray, w: int) -> np.ndarray:
    """Minimizers: positions whose hash ``g`` is least in some run of w grams with ``ok``
    (ok[i]: the run of w from i counts). Equal runs in any texts choose equal positions."""
    if len(ok) == 0:
        return np.zeros(len(g), bool)
    low = np.where(ok, sliding(g, w, np.minimum), np.uint64(0))
    pad = np.zeros(w - 1, np.uint64)
    top = sliding(np.concatenate([pad, low, pad]), w, np.maximum)
    return (top == g) & (top > 0)
