"""Word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

MEMO_WORDS = 60_000
_MEMO: dict[str, int] = {}
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space-separated words of all texts in a row, and how many each text has."""
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    at, memo = 0, _MEMO
    for words in split:
        if len(memo) > MEMO_WORDS:
            memo.clear()
        n = len(words)
        try:
            out[at : at + n] = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=n)
        except KeyError:
            for w in set(words).difference(memo):
                memo[w] = xxhash.xxh3_64_intdigest(w)
            out[at : at + n] = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=n)
        at += n
    return out, counts


def forget() -> None:
    _MEMO.clear()


def shingle_hashes(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, in order, and how many each text has.

    A text of fewer words (none at all, too) has one shingle of all its words.
    """
    words, counts = word_hashes(texts)
    n, short = len(words), counts < size
    rolled = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled += words[k : n - size + 1 + k] * _ODD[k] if n >= size else 0
    starts = np.cumsum(counts) - counts
    made = np.where(short, 1, counts - size + 1)
    out = np.empty(int(made.sum()), dtype=np.uint64)
    # of the windows over all words, those that stay inside one text
    inside = np.ones(len(rolled), dtype=bool)
    ends = np.cumsum(counts)
    for k in range(1, size):
        cut = ends - k
        cut = cut[(cut >= 0) & (cut < len(rolled))]
        inside[cut] = False
    long_places = np.ones(len(out), dtype=bool)
    first = np.cumsum(made) - made
    long_places[first[short]] = False
    # windows that start in a short text are never inside one text
    out[long_places] = rolled[inside]
    for i in np.flatnonzero(short):
        own = words[starts[i] : starts[i] + counts[i]]
        out[first[i]] = (int((own * _ODD[: len(own)]).sum(dtype=np.uint64)) + 0x5851F42D4C957F2D * (1 + int(counts[i]))) % 2**64
    return mix(out), made
