"""Vectorised Rabin-Karp hashing of words and word windows, modulo 2^64."""

from __future__ import annotations

import hashlib

import numpy as np

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_LONG = 1 << 16  # words of more bytes are hashed one by one


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n or more, modulo 2^64 (base is odd)."""
    for (own, size), tables in _tables.items():
        if own == base and size >= n:
            return tables
    size = 1 << max(10, (n - 1).bit_length())
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        table = np.full(size, x, np.uint64)
        table[0] = 1
        out.append(np.cumprod(table, dtype=np.uint64))
    for key in [k for k in _tables if k[0] == base]:
        del _tables[key]
    _tables[base, size] = (out[0], out[1])
    return _tables[base, size]


def word_hashes(words: list[bytes], step: int = 50_000) -> np.ndarray:
    """A 64-bit hash for each word, from prefix sums over the joined bytes."""
    out = np.zeros(len(words), np.uint64)
    for a in range(0, len(words), step):
        part = words[a:a + step]
        long = [i for i, w in enumerate(part) if len(w) > _LONG] if max(map(len, part)) > _LONG else []
        for i in long:
            out[a + i] = int.from_bytes(hashlib.blake2b(part[i], digest_size=8).digest(), "little")
        if long:
            part = [w if len(w) <= _LONG else b"" for w in part]
        lens = np.fromiter(map(len, part), np.int64, len(part))
        data = np.frombuffer(b"".join(part), np.uint8).astype(np.uint64) + np.uint64(1)
        up, down = _powers(int(_BYTE_BASE), len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * down[:len(data)], out=sums[1:])
        ends = np.cumsum(lens)
        own = mix((sums[ends] - sums[ends - lens]) * up[ends - lens]) ^ mix(lens.astype(np.uint64), 1)
        keep = np.ones(len(part), bool)
        keep[long] = False
        out[a:a + len(part)][keep] = own[keep]
    return out


def window_hashes(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """The hash of the ``size`` values from each position on (positions near the end: none)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers((0xD1342543DE82EF95 + 2 * salt) & (2**64 - 1) | 1, len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    mixed = mix(np.arange(256, dtype=np.uint64), salt)[words] if words.dtype == np.uint8 else mix(words, salt)
    np.cumsum(mixed * down[:len(words)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * up[:n], salt)


def inside(counts: np.ndarray, size: int) -> np.ndarray:
    """Start positions of the windows that lie inside one document, documents laid one after another."""
    total = int(counts.sum())
    ends = np.repeat(np.cumsum(counts), counts)
    at = np.arange(total)
    return at[at + size <= ends]
