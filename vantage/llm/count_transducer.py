"""One layer of an acyclic weighted automaton over words: arcs (start state, word) with weights, kept in order.

The automaton reads phrases word by word from the root. A state stands for one phrase, and the weight of
the arc into it is the phrase's count, so states of different phrases are not merged. Layer j holds the
arcs that read the j-th word; layers are added in turn, each from the sorted n-grams of the next length.
An arc is one integer, the start state above the word, so the order of arcs is that of the phrases.
"""

from __future__ import annotations

import numpy as np

WORD_BITS = 28
STATE_BITS = 63 - WORD_BITS


def pack(start: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << WORD_BITS) | word.astype(np.int64)


def start_of(arcs: np.ndarray) -> np.ndarray:
    return arcs >> WORD_BITS


def word_of(arcs: np.ndarray) -> np.ndarray:
    return arcs & ((1 << WORD_BITS) - 1)


def build(keys: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's layer from the arc each of its n-grams takes: arcs, weights, back links, and each n-gram's arc number.

    ``back`` is the state of the n-gram without its first word; it is the same for all n-grams of one arc.
    """
    arcs, first, which, weights = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return arcs, weights.astype(np.int64), back[first], which


def cut(arcs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each prefix range begins and ends in a layer (one more than there are ranges)."""
    return np.concatenate(([0], np.searchsorted(arcs, bounds), [len(arcs)]))


def union(layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard layers (arcs, weights, back links) as one: weights of equal arcs are summed, those below ``least`` go."""
    arcs, first, which = np.unique(np.concatenate([x[0] for x in layers]), return_index=True, return_inverse=True)
    total = np.zeros(len(arcs), np.int64)
    np.add.at(total, which, np.concatenate([x[1] for x in layers]))
    keep = total >= least
    return arcs[keep], total[keep], np.concatenate([x[2] for x in layers])[first[keep]]


def find(arcs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The number of each wanted arc in a layer, -1 where it is not there."""
    if not len(arcs):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
    return np.where(arcs[at] == wanted, at, -1)
