"""Word-shingle sets as sorted 64-bit hashes (numpy), used by the similarity join.

A word is a maximal run of characters other than space and \\t-\\r; A-Z are
lower-cased. UTF-8 keeps those bytes out of multi-byte characters, so the
work is done on bytes. Shingles are hashed to 64 bits: two different shingles
of one corpus meet with probability ~ m^2 / 2^65 and such a meeting changes an
overlap by one at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

PIECE = 1 << 20     # bytes hashed at once
POSITIONS = 64      # places in a word whose byte hashes are kept
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _byte_hashes(code: np.ndarray) -> np.ndarray:
    """Hashes of bytes at their places in a word: ``256 * place + byte``."""
    with np.errstate(over="ignore"):
        return mix((code.astype(np.uint64) + np.uint64(1)) * _A)


_TABLE = _byte_hashes(np.arange(256 * POSITIONS))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, starts)`` of the words of ``raw``: a word's hash is the sum of the hashes of its bytes by place.

    Bytes are worked on ``PIECE`` at a time; a word that a piece cuts is summed up over both.
    """
    hashes, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    open_word = -1      # start of the word that the last piece cut
    for at in range(0, len(raw), PIECE):
        buf = np.frombuffer(raw, np.uint8, min(PIECE, len(raw) - at), at)
        inside = ~_SPACE[buf]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first = np.flatnonzero(first)
        cut = open_word >= 0 and bool(inside[0])
        if len(first):
            begin = first.astype(np.int64)
            if cut:
                begin[0] = open_word - at
            head = int(first[0])
            place = np.arange(head, len(buf)) - np.repeat(begin, np.diff(first, append=len(buf)))
            code = place * 256 + _LOWER[buf[head:]]
            # white space after a word may lie beyond the kept places as well: it counts nothing
            value = _TABLE[np.minimum(code, len(_TABLE) - 1)]
            far = np.flatnonzero((code >= len(_TABLE)) & inside[head:])
            value[far] = _byte_hashes(code[far])
            value[~inside[head:]] = 0
            sums = np.add.reduceat(value, first - head)
            if cut:
                hashes[-1][-1:] += sums[:1]
                sums, begin = sums[1:], begin[1:]
            if len(sums):
                hashes.append(sums)
                starts.append(begin + at)
        open_word = int(starts[-1][-1]) if inside[-1] else -1
    return np.concatenate(hashes), np.concatenate(starts)


def _shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` word hashes."""
    acc = np.full(len(h) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            acc = mix(acc * _A + h[k:len(h) - width + 1 + k] * _B + _C)
    return acc


def _sets(raws: list[bytes], width: int) -> list[np.ndarray]:
    h, starts = word_hashes(b" ".join(raws))
    ends = np.cumsum([len(r) + 1 for r in raws])
    cuts = [0, *np.searchsorted(starts, ends).tolist()]
    whole = _shingles(h, width) if len(h) >= width else h[:0]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= width:
            s = np.sort(whole[a:b - width + 1])
        else:
            s = _shingles(h[a:b], b - a) if b > a else h[:0]
        out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) > 1 else s.copy())
    return out


def shingle_sets(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    """``shingle_set`` of each text, in order; many short texts are hashed together."""
    raws, size = [], 0
    for text in texts:
        raws.append(text.encode("utf-8", "surrogatepass") if text else b"")
        size += len(raws[-1]) + 1
        if size >= PIECE:
            yield from _sets(raws, width)
            raws, size = [], 0
    if raws:
        yield from _sets(raws, width)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of ``text``.

    Fewer words than ``width``: the whole sequence is the one shingle.
    No words or no text: the empty set.
    """
    return next(shingle_sets([text], width))


@lru_cache(maxsize=512)
def _range_starts(p: int) -> np.ndarray:
    return np.array([(j << 64) // p for j in range(p)], np.uint64)


class SizeClasses:
    """Block keys such that sets with Jaccard >= num/den share a known number of them.

    With ``J(A, B) >= num/den`` the symmetric difference of A and B holds at
    most ``k = floor((|A|+|B|) (den-num) / (den+num))`` elements. Cut the hash
    space into ``p > k`` ranges: in at least ``p - k`` of them A and B are
    equal. A range's key is a hash of the set's elements in it. The number of
    ranges depends on a size class; a set also emits the keys of the class of
    its largest possible partner, so a pair meets in the class of its larger
    member. Ranges that are empty in a set have no key; a set with ``z`` empty
    ranges shares at least ``p - k - z`` keys with any partner, which is its
    ``need``. Where that is not positive, the empty ranges have keys too and
    the need is 1. The low byte of a key is its class.
    """

    RATIO = 1.25
    LARGEST = 1 << 40

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold must be over 0 and at most 1")
        self.num, self.den = num, den
        bounds = [1]
        while bounds[-1] < self.LARGEST:
            bounds.append(max(bounds[-1] + 1, int(bounds[-1] * self.RATIO)))
        self.bounds = np.array(bounds, np.int64)
        self._cuts: dict[int, tuple[int, int]] = {}

    def of(self, sizes) -> np.ndarray:
        """Class of each set size."""
        return np.searchsorted(self.bounds, sizes)

    def _ranges(self, c: int) -> tuple[int, int]:
        """``(k, p)`` of a class: spare ranges outnumber the empty ones of its smallest sets."""
        if c not in self._cuts:
            k = 2 * int(self.bounds[c]) * (self.den - self.num) // (self.den + self.num)
            smallest = (int(self.bounds[c - 1]) + 1) * self.num // self.den if c else 1
            p = k + 2
            while p < 4 * k + 10:
                z = p * math.exp(-smallest / p)
                enough = math.ceil(k + 1 + z + 4 * math.sqrt(z))
                if p >= enough:
                    break
                p = enough
            self._cuts[c] = (k, p)
        return self._cuts[c]

    def _parts(self, s: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(class, need, start, stop, full)`` of a sorted set: its ranges, and which of them hold elements."""
        n = len(s)
        if n == 0:
            return
        first, last = self.of((n, n * self.den // self.num))
        for c in range(first, last + 1):
            k, p = self._ranges(c)
            if k == 0:
                continue
            start = np.searchsorted(s, _range_starts(p))
            stop = np.append(start[1:], n)
            full = stop > start
            yield c, p - k - int(p - full.sum()), start, stop, full

    def needs(self, s: np.ndarray) -> list[tuple[int, int]]:
        """``(class, need)`` as in ``keys``, without the keys."""
        return [(c, max(need, 1)) for c, need, *_ in self._parts(s)]

    def keys(self, s: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """``(class, need, keys)`` of a sorted set; classes where only an equal set links are left out."""
        out, sums = [], np.zeros(len(s) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(s ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
            for c, need, start, stop, full in self._parts(s):
                keys = mix((sums[stop] - sums[start]) * _A + np.arange(len(start), dtype=np.uint64) * _B + np.uint64(c))
                keys = keys & ~np.uint64(0xFF) | np.uint64(c)
                out.append((c, need, keys[full]) if need > 0 else (c, 1, keys))
        return out
