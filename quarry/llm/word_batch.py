"""Words of a batch of texts as numpy arrays over the UTF-8 bytes.

One pass finds all words; hashes of words and of their prefixes and suffixes
are differences of one running polynomial, so no Python string is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from quarry.llm.common import slices

_BASE = np.uint64(0x9E6F2D1C3B5A4897)  # odd: invertible modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
UNCHANGED = np.arange(256, dtype=np.uint8)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
SPACE_BYTES = [bytes([b]) for b in np.flatnonzero(SPACE).tolist()]
NOT_ALNUM = np.ones(256, bool)  # ASCII only: every byte of a longer code point counts as a letter
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every bit of the result depends on every bit of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def stable_order(h: np.ndarray) -> np.ndarray:
    """As ``argsort(h, kind="stable")`` of hashes (uint64): their upper bits and
    the places are sorted as one number, which is several times faster.  Hashes
    that differ only in the bits left out are sorted as they are."""
    bits = np.uint64(len(h).bit_length())
    place = np.arange(len(h), dtype=np.uint64)
    packed = np.sort(h >> bits << bits | place)
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    sorted_ = h[order]
    if (sorted_[1:] < sorted_[:-1]).any() or ((packed[1:] ^ packed[:-1]) >> bits == 0)[sorted_[1:] != sorted_[:-1]].any():
        return np.argsort(h, kind="stable")
    return order


class Running:
    """Hashes of byte ranges by differences of a running polynomial."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _pow(len(data) + 1)
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=self.sum[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sum[hi] - self.sum[lo]) * self.inverse[lo])


class Words:
    """``data`` the bytes of all texts; ``start``/``end`` of each word;
    ``doc`` the text a word belongs to; ``count`` words per text."""

    def __init__(self, texts: pa.Array, separator: np.ndarray = SPACE, fold: np.ndarray = LOWER):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        n = len(self.data)
        inside = ~separator[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        self.start = np.flatnonzero(inside & ~(before & ~edge[:n]))
        self.end = np.flatnonzero(inside & ~(after & ~edge[1:])) + 1
        cuts = np.searchsorted(self.start, self.offsets)
        self.first, self.count = cuts[:-1], np.diff(cuts)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.lower = fold[self.data]
        self.running = Running(self.lower)
        self._distinct = None

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return self.running.of(self.start, self.end)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``numpy.unique`` of the hashes: the different ones, the first word
        of each, and which of them each word has; worked out once."""
        if self._distinct is None:
            hashes = self.hashes()
            order = stable_order(hashes)
            new = np.ones(len(order), bool)
            new[1:] = hashes[order[1:]] != hashes[order[:-1]]
            which = np.empty(len(order), np.int64)
            which[order] = np.cumsum(new) - 1
            self._distinct = hashes[order[new]], order[new], which
        return self._distinct

    def prefix(self, k: int) -> np.ndarray:
        """Hash of the first ``k`` bytes (the whole word if shorter)."""
        return self.running.of(self.start, np.minimum(self.start + k, self.end))

    def suffix(self, k: int) -> np.ndarray:
        return self.running.of(np.maximum(self.end - k, self.start), self.end)

    def repeats(self, hashes: np.ndarray) -> np.ndarray:
        """Whether a word equals the one before it in its text."""
        same = np.zeros(len(self), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (self.doc[1:] == self.doc[:-1])
        return same


def pieces(text: bytes, limit: int = 1 << 20) -> Iterator[bytes]:
    """``text`` in pieces of about ``limit`` bytes, cut at white space (a longer
    word stays whole)."""
    lo = 0
    while lo < len(text):
        hi = lo + limit
        if hi < len(text):
            cut = max(text.rfind(b, lo, hi) for b in SPACE_BYTES)
            if cut <= lo:  # no white space but ahead: on to the next
                found = [c for c in (text.find(b, hi) for b in SPACE_BYTES) if c >= 0]
                cut = min(found, default=len(text))
            hi = cut
        yield text[lo:hi]
        lo = hi


def exact_hashes(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, hashes of its words)`` of every text, case kept; short texts are
    hashed together, a long one piece by piece."""
    for lo, hi in slices(texts, limit):
        some = texts.slice(lo, hi - lo)
        if hi - lo == 1 and len(text := some[0].as_buffer().to_pybytes()) > limit:
            yield lo, np.concatenate([Words(pa.array([p], pa.large_binary()), fold=UNCHANGED).hashes() for p in pieces(text, limit)])
            continue
        w = Words(some, fold=UNCHANGED)
        hashes = w.hashes()
        for row, (first, n) in enumerate(zip(w.first.tolist(), w.count.tolist())):
            yield lo + row, hashes[first:first + n]


def word_batches(texts: pa.Array, separator: np.ndarray = SPACE, limit: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """``(lo, hi, words)`` of consecutive row ranges of at most ``limit`` bytes (a longer text alone)."""
    for lo, hi in slices(texts, limit):
        yield lo, hi, Words(texts.slice(lo, hi - lo), separator)
