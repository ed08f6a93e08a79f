"""Word shingles as sets of 64-bit hashes, and their circulant MinHash signatures. Runs inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

# The universe that signatures permute; sets keep all 64 bits of their hashes.
UNIVERSE_BITS = 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Words whose hash a worker remembers before it starts anew.
REMEMBERED_WORDS = 1_000_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose outputs look unrelated."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of the whole text if it has fewer.

    ASCII letters are lower-cased and words end at space and the controls 9 to
    13, which is what ``bytes`` methods do.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    run = min(words, len(found))
    joined = np.full(len(found) - run + 1, run, np.uint64)
    for i in range(run):
        joined = joined * _MULTIPLIER + hashes[i : len(found) - run + 1 + i]
    return np.unique(mixed(joined))


@lru_cache(maxsize=2)
def _permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << UNIVERSE_BITS
    rng = np.random.default_rng(20_240_229)
    first = rng.permutation(size).astype(np.uint32)
    second = rng.permutation(size).astype(np.uint32)
    # Row i holds the second permutation's values at i, i + 1, ... around the circle.
    around = np.concatenate([second, second[:coordinates]])
    return first, np.lib.stride_tricks.sliding_window_view(around, coordinates)


def signature(members: np.ndarray, coordinates: int) -> np.ndarray:
    """Coordinate ``k``: the least value over the set of permutation two, shifted by ``k``, after permutation one.

    The shifts of one element lie next to each other in memory, so a set costs
    one read of ``coordinates`` numbers per element.
    """
    first, shifted = _permutations(coordinates)
    places = first[(members >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    least = np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(places), 2048):
        np.minimum(least, shifted[places[start : start + 2048]].min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per ``rows`` consecutive coordinates; bands never share keys but by chance."""
    bands = coordinates.reshape(-1, rows).astype(np.uint64)
    keys = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for column in bands.T:
        keys = mixed(keys * _MULTIPLIER + column)
    return keys
