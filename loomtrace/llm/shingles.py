"""Word shingles as 64-bit fingerprints, computed with numpy on UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Words are runs of bytes other than these: space and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PRIME = np.uint64(0x100000001B3)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the words of all texts in order; ``between`` has the bytes of no word."""
    solid = ~between[data]
    if not solid.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False  # a word does not go on in the next text
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[inner - 1] = False
    return starts, np.flatnonzero(solid & ~after) + 1 - starts


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): words of text i have hashes[first[i]:first[i + 1]]; A-Z count as a-z, and ``between`` has the bytes of no word."""
    starts, lengths = runs(data, offsets, between)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    hashes = lengths.astype(np.uint64) * _STEP
    # Column by column over the words that are still that long; the few very long
    # words are folded one by one, each in blocks.
    ordered = np.argsort(-lengths, kind="stable")
    sizes = -lengths[ordered]
    most = int(np.searchsorted(sizes, -64, "left"))
    for i in ordered[:most]:
        hashes[i] ^= _long_word(low[starts[i] : starts[i] + lengths[i]])
    rest = ordered[most:]
    sizes, at, h = sizes[most:], starts[rest], hashes[rest]
    for j in range(64):
        n = int(np.searchsorted(sizes, -j, "left"))  # words longer than j
        if not n:
            break
        h[:n] = (h[:n] ^ low[at[:n] + j]) * _PRIME
        h[:n] ^= h[:n] >> np.uint64(29)
    hashes[rest] = h
    return mix(hashes), np.searchsorted(starts, offsets, "left")


def _long_word(piece: np.ndarray) -> np.uint64:
    padded = np.zeros((len(piece) + 7) // 8 * 8, np.uint8)
    padded[: len(piece)] = piece
    cells = padded.view("<u8").astype(np.uint64)
    places = mix(np.arange(1, len(cells) + 1, dtype=np.uint64) * _STEP)
    return np.bitwise_xor.reduce(mix(cells ^ places)) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct fingerprints of its shingles, as int64.

    A text with fewer than ``size`` words has its whole word sequence as one
    shingle; a text without words has none.
    """
    hashes, first = words(data, offsets)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    if n >= size:
        m = n - size + 1
        acc = hashes[:m].copy()
        for j in range(1, size):
            acc *= _PRIME
            acc += hashes[j : j + m]
            acc ^= acc >> np.uint64(31)
        rolled[:m] = mix(acc)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        count = high - low
        if count >= size:
            values = np.sort(rolled[low : high - size + 1].view(np.int64))
            yield values[np.concatenate(([True], values[1:] != values[:-1]))]
        elif count:
            with np.errstate(over="ignore"):
                acc = np.uint64(count) * _STEP
                for h in hashes[low:high]:
                    acc = (acc ^ h) * _PRIME
                    acc ^= acc >> np.uint64(29)
            yield mix(np.array([acc], np.uint64)).view(np.int64)
        else:
            yield np.empty(0, np.int64)


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of fingerprints."""
    if not len(values):
        return 0, 0
    bits = values.view(np.uint64)
    a = np.add.reduce(mix(bits ^ _STEP))
    b = np.bitwise_xor.reduce(mix(bits + _PRIME))
    return int(a.view(np.int64)), int(b.view(np.int64))
