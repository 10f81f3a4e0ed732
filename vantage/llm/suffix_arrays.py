"""Bounded suffix orders of byte strings, and the merge of shard transforms by interleave refinement."""

from __future__ import annotations

import numpy as np


def step_of(size: int) -> int:
    """Bytes that one round compares: the largest divisor of ``size`` from 16 to 64."""
    for step in range(64, 15, -1):
        if size % step == 0:
            return step
    raise ValueError("size must have a divisor from 16 to 64")


def stable_order(symbols: np.ndarray) -> np.ndarray:
    """The stable order of non-negative integers, dealt by 16 bits at a time from the lowest."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    most, shift = int(symbols.max(initial=0)), 16
    while most >> shift:
        order = order[np.argsort((symbols >> shift & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


def dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(keys)
    own = keys[order]
    out = np.empty(len(keys), np.int64)
    if len(keys):
        new = np.zeros(len(keys), np.int32)
        np.cumsum(own[1:] != own[:-1], out=new[1:])
        out[order] = new
    return out


def ahead(rank: np.ndarray, left: np.ndarray, by: int) -> np.ndarray:
    """The rank ``by`` positions on, plus one; 0 past the end of the string (``left`` bytes are left)."""
    out = np.zeros(len(rank), np.int64)
    out[:-by] = rank[by:] + 1
    out[left <= by] = 0
    return out


def gram_ranks(data: np.ndarray, left: np.ndarray, step: int) -> np.ndarray:
    """The rank of the ``step`` bytes at each position; a string that ends before sorts first."""
    key = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    for width in (1, 2, 4):
        key[:-width] = (key[:-width] << np.uint64(8 * width)) | key[width:]
    key = key[:len(data)]
    short = np.flatnonzero(left < 8)
    gone = (8 * (8 - left[short])).astype(np.uint64)
    key[short] = (key[short] >> gone) << gone
    rank, depth = dense(key), 8
    while depth < step:
        by = min(depth, step - depth)
        rank = dense(rank * (len(rank) + 1) + ahead(rank, left, by))
        depth += by
    return rank


def suffix_ranks(grams: np.ndarray, step: int, size: int) -> np.ndarray:
    """Each suffix's rank in one string by the first ``size`` bytes (equal ones: the same)."""
    left = np.arange(len(grams), 0, -1)
    rank, depth, most = grams, step, int(grams.max(initial=0)) + 2
    while depth < size:
        by = min(depth, size - depth)
        rank, most = dense(rank * most + ahead(rank, left, by)), len(grams) + 2
        depth += by
    return rank


def merged_classes(shards: list[np.ndarray], size: int) -> np.ndarray:
    """For every position of the shards, laid one after another, the class of its first ``size`` bytes.

    Each shard is transformed by itself: suffix order, and before each suffix the gram of ``step``
    bytes that precedes it. The merge holds only the interleave, the shard of each merged suffix. A
    round reads the shards' transforms through the interleave and deals its entries stably by the
    preceding gram: suffixes then stand in order of ``step`` more bytes. A boundary appears where
    the gram changes or a boundary stood between the sources, so after ``size / step`` rounds two
    neighbours have a common prefix of ``size`` bytes if no boundary divides them. No suffix is
    compared with another shard's.
    """
    step = step_of(size)
    if not shards:
        return np.zeros(0, np.int64)
    closed = [np.append(x, np.uint8(0)) for x in shards]  # so that a string of ``size`` bytes never ends its shard
    sizes = np.array([len(x) for x in closed], np.int64)
    total = int(sizes.sum())
    shard = np.repeat(np.arange(len(shards)), sizes).astype(np.uint16 if len(shards) < 1 << 16 else np.uint32)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(total)
    left = np.repeat(np.cumsum(sizes), sizes) - at
    grams = gram_ranks(np.concatenate(closed), left, step).astype(np.int32)
    suffix = np.empty(total, np.int64)  # shard by shard, in suffix order: the suffix's position
    for a, n in zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist()):
        suffix[a:a + n] = a + stable_order(suffix_ranks(grams[a:a + n].astype(np.int64), step, size))
    before = np.where(suffix - start >= step, grams[np.maximum(suffix - step, 0)], -1)
    tails = suffix[left[suffix] <= step]  # no suffix stands ``step`` bytes after these
    interleave, block = shard.copy(), np.zeros(total, np.int32)
    for _ in range(size // step):
        place = np.argsort(interleave, kind="stable")
        symbol = np.empty(total, np.int32)
        symbol[place] = before
        has = np.flatnonzero(symbol >= 0)
        symbol = np.concatenate((grams[tails], symbol[has]))
        order = stable_order(symbol)
        symbol = symbol[order]
        source = np.concatenate((np.full(len(tails), -1, np.int32), block[has]))[order]
        interleave = np.concatenate((shard[tails], interleave[has]))[order]
        block = np.zeros(total, np.int32)
        np.cumsum((symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1]), out=block[1:])
    out = np.empty(total, np.int64)
    out[suffix] = block[np.argsort(interleave, kind="stable")]
    return out[left > 1]
