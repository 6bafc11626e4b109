"""Weighted shingles and consistent weighted samples for operator 1.

A document's features are its distinct runs of five words, weighted by
``(1 + ln tf) * idf`` with ``idf = log2(1 + total / df)``, where ``total`` is
the number of features of all documents.  Frequencies are exact for every
shingle that makes up ``1 / SHARES`` of the total or more, and all rarer ones
weigh as if they made up that much.  So there are at most ``SHARES`` frequent
ones in any corpus, and a weight follows from the shingle's share of the
corpus, not from the corpus's size.

Two documents are alike if the weighted or the plain Jaccard similarity of
their features is high enough: a copy's few new shingles are rare and what it
shares with very many copies is not, so by weight alone it may fall apart from
them at 0.89.  The samples are drawn by the fourth root of the weights, which
lies between the two: of 0.8 by either, at least 0.75 is left.

Improved consistent weighted sampling: per sample, each feature draws
``r, c ~ Gamma(2, 1)`` and ``b ~ U(0, 1)`` from its hash, quantizes its log
weight to ``t = floor(ln w / r + b)`` and bids ``ln c - r * (t - b + 1)``; the
lowest bid's feature and ``t`` are the sample.  Two documents draw equal
samples with the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

from .common import Prefix, mix, mix_in_place, words

SHINGLE = 5
SHARES = 1 << 20
ROOT = 0.25
SAMPLES, BANDS = 60, 15
#: Bytes of text whose shingles are made at once: few enough for a core's cache.
SLICE = 1 << 17
#: Further samples, one byte each, of documents that the first leave undecided.
FINE_SAMPLES = 192

_LEVELS = 1 << 16


def _gamma2(p: np.ndarray) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x)."""
    x = np.ones_like(p) * 1.7
    low, high = np.zeros_like(p), np.full_like(p, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x


_Q = _gamma2((np.arange(_LEVELS) + 0.5) / _LEVELS)
_R, _LN_C = _Q.astype(np.float32), np.log(_Q).astype(np.float32)
_SEEDS = mix(np.arange(1, SAMPLES + FINE_SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(off: np.ndarray, body: np.ndarray, width: int = SHINGLE
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of every document: ``(first feature of each document
    and the total, hashes, counts)``.  A text of fewer words is one feature."""
    start, end, first = words(off, body)
    seq = Prefix(Prefix.of_bytes(body).hash(start, end))
    size = np.diff(first)
    n = np.where(size >= width, size - width + 1, (size > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(size)), n)
    at = np.repeat(first[:-1], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    h = seq.hash(at, np.minimum(at + width, first[1:][doc]))
    ends = np.cumsum(n).tolist()
    for i, j in zip([0, *ends], ends):  # each document's by itself: short, and sorted in place
        if j - i > 1:
            h[i:j].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    keep = np.flatnonzero(new)
    return (np.searchsorted(doc[keep], np.arange(len(size) + 1)), h[keep],
            np.diff(np.append(keep, len(h))))


class Rarity:
    """idf of shingles, by the exact frequencies of the frequent ones."""

    def __init__(self, keys: np.ndarray, df: np.ndarray, total: int):
        order = np.argsort(keys)
        self.keys = keys[order]
        least = max(1.0, total / SHARES)
        self.idf = np.log2(1 + total / np.maximum(df[order], least)).astype(np.float32)
        self.rest = np.float32(np.log2(1 + total / least))
        self.shift = np.uint64(64 - min(23, max(8, (4 * len(keys)).bit_length())))
        self._maybe: np.ndarray | None = None  # made where it is used, not sent

    def of(self, h: np.ndarray) -> np.ndarray:
        if self._maybe is None:
            self._maybe = np.zeros(1 << (64 - int(self.shift)), bool)
            self._maybe[self.keys >> self.shift] = True
        out = np.full(len(h), self.rest, np.float32)
        some = np.flatnonzero(self._maybe[h >> self.shift])
        if len(some):
            slot = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
            found = self.keys[slot] == h[some]
            out[some[found]] = self.idf[slot[found]]
        return out


def weights(h: np.ndarray, count: np.ndarray, rarity: Rarity) -> np.ndarray:
    return (1 + np.log(count.astype(np.float32))) * rarity.of(h)


def samples(first: np.ndarray, h: np.ndarray, w: np.ndarray, start: int = 0, count: int = SAMPLES) -> np.ndarray:
    """``(documents with features) x count`` sample codes of the weights'
    roots, from sample ``start`` on."""
    has = np.flatnonzero(np.diff(first))
    begin, size = first[:-1][has], np.diff(first)[has]
    out = np.empty((len(has), count), np.uint16)
    if not len(has):
        return out
    ln = (ROOT * np.log(w)).astype(np.float32)
    owner = np.repeat(np.arange(len(has)), size)
    z, spare, index = np.empty_like(h), np.empty_like(h), np.empty(len(h), np.intp)
    bid, r, b, t = (np.empty(len(h), np.float32) for _ in range(4))
    draws = z.view("<u2").reshape(-1, 4)  # three draws of 16 bits of each hash
    for k in range(count):
        np.bitwise_xor(h, _SEEDS[start + k], out=z)
        mix_in_place(z, spare)
        index[:] = draws[:, 0]
        _R.take(index, out=r, mode="clip")
        np.multiply(draws[:, 2], np.float32(1 / _LEVELS), out=b, dtype=np.float32, casting="unsafe")
        np.divide(ln, r, out=t)
        t += b
        np.floor(t, out=t)
        np.subtract(t, b, out=b)
        b += np.float32(1)
        b *= r
        index[:] = draws[:, 1]
        _LN_C.take(index, out=bid, mode="clip")
        bid -= b
        least = np.minimum.reduceat(bid, begin)
        won = np.flatnonzero(bid == np.repeat(least, size))  # on a tie the smallest hash
        one = won[np.concatenate([[True], owner[won][1:] != owner[won][:-1]])]
        code = mix(h[one] ^ (t[one].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        out[:, k] = (code >> np.uint64(48)).astype(np.uint16)
    return out


def bands(codes: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band."""
    rows = SAMPLES // BANDS
    out = np.empty((len(codes), BANDS), np.uint64)
    for j in range(BANDS):
        key = np.full(len(codes), j + 1, np.uint64)
        for c in codes[:, j * rows:(j + 1) * rows].T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
        out[:, j] = key
    return out


def similarity(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Weighted or plain Jaccard similarity, the larger, of two feature lists
    sorted by hash."""
    if not len(ha) or not len(hb):
        return 0.0
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    low = float(np.minimum(wa[ia], wb[ib]).sum(dtype=np.float64))
    weighted = low / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - low)
    return max(weighted, len(ia) / (len(ha) + len(hb) - len(ia)))
