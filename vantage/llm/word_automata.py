"""Minimal acyclic acceptors of word lists, and the pairs their composition with a one-edit transducer accepts."""

from __future__ import annotations

from collections.abc import Iterator


class Acceptor:
    """The minimal deterministic acyclic acceptor of distinct words given in ascending order.

    Built word by word: once the next word leaves a path, the states behind it cannot change any more
    and are replaced by registered ones with the same final mark and arcs; their numbers are used again, so
    memory is that of the minimal acceptor.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        register: dict = {}
        path: list[tuple[int, str, int]] = []  # (from, label, to) along the last word
        last = ""
        free: list[int] = []  # replaced states

        def settle(depth: int) -> None:
            while len(path) > depth:
                start, label, end = path.pop()
                key = (self.final[end], tuple(self.arcs[end].items()))
                known = register.setdefault(key, end)
                if known != end:
                    self.arcs[start][label] = known
                    self.arcs[end] = {}
                    free.append(end)
        for word in words:
            depth = 0
            for x, y in zip(word, last):
                if x != y:
                    break
                depth += 1
            settle(depth)
            state = path[-1][2] if path else 0
            for label in word[depth:]:
                if free:
                    new = free.pop()
                    self.final[new] = False
                else:
                    new = len(self.arcs)
                    self.arcs.append({})
                    self.final.append(False)
                self.arcs[state][label] = new
                path.append((state, label, new))
                state = new
            self.final[state] = True
            last = word
        settle(0)

    def common(self, one: int, two: int) -> Iterator[str]:
        """The strings that both states accept: paths through the product of their parts."""
        path: list[str] = []
        stack: list[tuple[int, str, int, int]] = [(0, "", one, two)]
        while stack:
            depth, label, a, b = stack.pop()
            del path[max(depth - 1, 0):]
            if depth:
                path.append(label)
            if self.final[a] and self.final[b]:
                yield "".join(path)
            there = self.arcs[b]
            for c, to in self.arcs[a].items():
                if c in there:
                    stack.append((depth + 1, c, to, there[c]))

    def edits(self, state: int, at_end: bool) -> list[tuple[str, str]]:
        """Pairs accepted from ``state`` that differ at once: the transducer's edit is the first thing it does.

        A replaced symbol (the smaller first), or one that only the second string has. Equal symbols are
        always read as a match, so every pair has one path. ``at_end``: also after the first one's end.
        """
        arcs = list(self.arcs[state].items())
        found = []
        for i, (c, to) in enumerate(arcs):
            for d, other in arcs[i + 1:]:
                found += [(c + s, d + s) for s in self.common(to, other)]
            if self.final[state] or len(arcs) > 1:
                found += [(s, c + s) for s in self.common(state, to) if s[:1] != c and (s or at_end)]
        return found

    def one_edit_pairs(self, at_end: bool = True) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words that differ by one replaced or one inserted symbol, once (the shorter or smaller first).

        The composition of this acceptor, a transducer with one edit, and this acceptor again: until the
        edit both sides are in the same state, after it they follow equal symbols.
        """
        path: list[str] = []
        memo: dict[int, list[tuple[str, str]]] = {}
        stack: list[tuple[int, str, int]] = [(0, "", 0)]
        while stack:
            depth, label, state = stack.pop()
            del path[max(depth - 1, 0):]
            if depth:
                path.append(label)
            arcs = self.arcs[state]
            if len(arcs) > 1 or self.final[state] and arcs:
                if state not in memo:
                    memo[state] = self.edits(state, at_end)
                if memo[state]:
                    head = "".join(path)
                    for x, y in memo[state]:
                        yield head + x, head + y
            stack.extend((depth + 1, c, to) for c, to in arcs.items())
