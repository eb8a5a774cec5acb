"""Word shingles of whole texts as 64-bit hashes, in numpy on UTF-8 bytes.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, with A-Z in
lower case.  A word's hash is a polynomial over random byte values modulo
2^64, finished by a mixing step; a shingle's hash mixes those of its words.
"""

from __future__ import annotations

import functools

import numpy as np

_RNG = np.random.default_rng(20240229)
_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[ord("A"):ord("Z") + 1] = _VALUES[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = int(_RNG.integers(1 << 40, 1 << 62)) * 8 + 5
_PLACE = _RNG.integers(1 << 40, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of ``x`` reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    out = []
    for base in (_BASE % (1 << 64), pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes' places of the words in UTF-8 ``data``."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = 1 << max(10, int(len(data) + 1).bit_length())
    power, inverse = _powers(n)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts]), starts


def text_words(data: bytes) -> np.ndarray:
    """Word hashes of one text of any length, piece by piece."""
    view, at, found = np.frombuffer(data, np.uint8), 0, []
    while at < len(view):
        stop = min(at + PIECE, len(view))
        while stop < len(view):  # on to the end of the word
            near = np.flatnonzero(_SPACE[view[stop:stop + 4096]])
            if len(near):
                stop += int(near[0])
                break
            stop = min(stop + 4096, len(view))
        found.append(word_hashes(view[at:stop])[0])
        at = stop
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; of the whole sequence
    if it has fewer words; none without words."""
    n = len(words)
    if not n:
        return words
    wide = min(n, width)
    total = np.full(n - wide + 1, wide, np.uint64)
    for j in range(wide):
        total = total + words[j:n - wide + 1 + j] * _PLACE[j]
    return np.unique(mix(total))


def slice_words(texts: list[bytes]):
    """Word hashes of each of several texts; short ones are hashed together."""
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < PIECE):
            size += len(texts[stop]) + 1
            stop += 1
        if stop == at + 1:
            yield text_words(texts[at])
        else:
            words, starts = word_hashes(np.frombuffer(b" ".join(texts[at:stop]), np.uint8))
            first = np.cumsum([0] + [len(t) + 1 for t in texts[at:stop]])
            cuts = np.searchsorted(starts, first)
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield words[a:b]
        at = stop
