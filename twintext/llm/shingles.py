"""Word shingles of texts as 64-bit hashes, with numpy, a batch of texts at a time.

Words are runs of bytes other than space and tab to carriage return, A-Z in
lower case; a shingle is ``k`` consecutive words. A text with fewer words is one
shingle, a text without words none. Shingles are told apart by their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

_PIECE = 1 << 20  # bytes hashed at once, unless a single word is longer
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers, the same in every task."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, "u8") * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE, "u8"), np.full(size, inverse, "u8")
    up[0] = down[0] = 1
    return np.cumprod(up, dtype="u8"), np.cumprod(down, dtype="u8")


@lru_cache
def _byte_values() -> np.ndarray:
    values = random_words(256, 7)
    values[65:91] = values[97:123]  # A-Z as a-z
    return values


@lru_cache
def _white() -> np.ndarray:
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    return white


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    edges = np.diff(_white()[data].astype("i1"), prepend=np.int8(1), append=np.int8(1))
    first, past = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    up, down = _powers(max(_PIECE, 1 << int(len(data)).bit_length()) + 1)
    sums = np.zeros(len(data) + 1, "u8")
    np.cumsum(_byte_values()[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[past] - sums[first]) * down[first]), first


def _cuts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of one long text that end at white space."""
    white = _white()
    while len(data) > _PIECE:
        at = np.flatnonzero(white[data[:_PIECE]])
        if len(at):
            end = int(at[-1]) + 1
        else:
            more = np.flatnonzero(white[data[_PIECE:]])
            end = _PIECE + int(more[0]) + 1 if len(more) else len(data)
        yield data[:end]
        data = data[end:]
    yield data


def words_of(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of consecutive texts, and how many words each of these has."""
    held: list[bytes] = []
    size = 0

    def together() -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b" ".join(held), "u1")
        hashes, first = _word_hashes(data)
        ends = np.cumsum([len(t) + 1 for t in held])
        return hashes, np.diff(np.searchsorted(first, ends), prepend=0)

    for text in texts:
        if held and size + len(text) > _PIECE:
            yield together()
            held, size = [], 0
        if len(text) > _PIECE:
            parts = [_word_hashes(p)[0] for p in _cuts(np.frombuffer(text, "u1"))]
            hashes = np.concatenate(parts)
            yield hashes, np.array([len(hashes)])
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield together()


def sets_of(texts: Sequence[bytes], k: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    factors = random_words(k, 11)
    short = random_words(k, 13)
    for hashes, counts in words_of(texts):
        n = max(0, len(hashes) - k + 1)
        grams = np.zeros(n, "u8")
        for j in range(k):
            grams += hashes[j : j + n] * factors[j]
        grams = mixed(grams)
        start = 0
        for count in counts:
            if count >= k:
                yield np.unique(grams[start : start + count - k + 1])
            elif count:
                whole = (hashes[start : start + count] * factors[:count]).sum(dtype="u8")
                yield mixed(short[count : count + 1] + whole)
            else:
                yield np.zeros(0, "u8")
            start += count
