"""Vectorised word splitting and hashing of UTF-8 text, shared by the NumPy operators.

Texts are taken in blocks of a few MB so that the work arrays stay bounded; one text
longer than a block forms a block of its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Fixed values of the contracts: ASCII white space, and A-Z to a-z.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))

BLOCK_BYTES = 1 << 19
_M64 = (1 << 64) - 1


def separators(chars: bytes) -> np.ndarray:
    """Byte → is it a word separator."""
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values.  Sorting beats ``np.unique``, which hashes them."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class Powers:
    """Powers of an odd multiplier modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, multiplier: int):
        self.m, self.inv = multiplier | 1, pow(multiplier | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.m, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inv, k, 1 << 64))])
        return self.up[:n], self.down[:n]


# Two independent multipliers: one gives a 64-bit word key, both a 128-bit one.
POWERS = (Powers(0x9E3779B97F4A7C15), Powers(0xD1B54A32D192ED03))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of a block of texts: byte ranges, and the first word of each text."""

    def __init__(self, texts: list[bytes], sep: np.ndarray):
        # every text is closed by a separator, so no word crosses two texts
        close = bytes([int(np.flatnonzero(sep)[0])])
        self.bytes = np.frombuffer(close + close.join(texts) + close, np.uint8)
        inside = ~sep[self.bytes]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = edge[::2], edge[1::2]
        text_start = np.cumsum([1, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.start, text_start)  # len(texts) + 1 entries

    def __len__(self) -> int:
        return len(self.start)

    def keys(self, which: int = 0) -> np.ndarray:
        """A 64-bit key per word: the polynomial hash of its bytes, finalised."""
        n = len(self.bytes)
        up, down = POWERS[which].get(n)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])

    def text(self, a: int, b: int) -> list[bytes]:
        """Words a to b (exclusive) as bytes."""
        raw = self.bytes
        return [raw[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b])]


def blocks(texts, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as UTF-8) for runs of texts of at most ``limit``
    bytes; null is an empty text."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if run and size + len(b) > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(b)
        size += len(b) + 1
    if run:
        yield first, run


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers from a linear congruence."""
    out, x = [], (seed * 0x9E3779B97F4A7C15 + 0x1234567) & _M64
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) & _M64
        out.append((x ^ (x >> 29)) | 1)
    return np.array(out, np.uint64)


def windows(keys: np.ndarray, first: np.ndarray, n: int, mult: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all windows of n consecutive words, and which of them lie in one text.

    Entry i of the first array is the key of words i to i+n-1; the second array is
    True where these belong to the same text."""
    m = max(0, len(keys) - n + 1)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += keys[j:j + m] * mult[j]
    inside = np.ones(m, bool)
    for a in first[1:-1]:  # windows that begin less than n words before a text's end
        inside[max(0, a - n + 1):a] = False
    return mix(out), inside
