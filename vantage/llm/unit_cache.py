"""Encoding by units: a tokenizer that never crosses unit borders encodes each distinct unit once.

Used inside tasks. The cache is emptied when it holds ``limit`` units, so its memory is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, repeat

import numpy as np


class UnitCache:
    """``encode`` gives the ids of new units: a list for each, or one array of all and their lengths."""

    def __init__(self, encode: Callable[[list], list[list[int]] | tuple], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.at: dict = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lens = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _add(self, units: list) -> None:
        found = self.encode(units)
        if isinstance(found, tuple):
            ids, lens = found
        else:
            lens = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lens.sum()))
        k, n, total = len(self.at), len(lens), int(lens.sum())
        while k + n > len(self.starts):
            self.starts, self.lens = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lens, 2 * len(self.lens))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:self.used + total] = ids
        self.starts[k:k + n], self.lens[k:k + n] = self.used + np.cumsum(lens) - lens, lens
        self.used += total
        self.at.update(zip(units, range(k, k + n)))

    def _find(self, units: list) -> np.ndarray:
        return np.fromiter(map(self.at.get, units, repeat(-1)), np.int64, len(units))

    def __call__(self, units: list, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after another, and how many each unit has; of ``units[places]`` if given."""
        which = self._find(units)
        missed = np.flatnonzero(which < 0)
        new = list(dict.fromkeys([units[i] for i in missed.tolist()]))
        if len(self.at) + len(new) > self.limit and self.at:
            self._clear()
            missed, new = np.arange(len(units)), list(dict.fromkeys(units))
        if new:
            self._add(new)
            which[missed] = self._find([units[i] for i in missed.tolist()])
        if places is not None:
            which = which[places]
        lens = self.lens[which]
        total = int(lens.sum())
        ends = np.cumsum(lens)
        gather = np.arange(total) + np.repeat(self.starts[which] - (ends - lens), lens)
        return self.flat[gather], lens


def text_slices(batches: Iterable, column: str, max_bytes: int = 4 << 20):
    """Arrow batches cut so that a slice's text stays near ``max_bytes`` (a longer text is a slice by itself)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
