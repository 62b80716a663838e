"""Automata over words (suffix automaton) and over bytes (longest-match automaton)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added. State 0 is the empty one; per state: transitions, the
    suffix link, the length of its longest string, and how many of the added places end with it
    (after :meth:`count`)."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.seen = [0]

    def _state(self, length: int, link: int = 0, moves: dict | None = None) -> int:
        self.next.append(moves if moves is not None else {})
        self.link.append(link)
        self.length.append(length)
        self.seen.append(0)
        return len(self.link) - 1

    def _split(self, at: int, symbol: int) -> int:
        """The state after ``symbol`` whose longest string is the one of ``at`` with the symbol."""
        to = self.next[at][symbol]
        if self.length[to] == self.length[at] + 1:
            return to
        copy = self._state(self.length[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while at >= 0 and self.next[at].get(symbol) == to:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            return self._split(last, symbol)
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        self.link[new] = 0 if at < 0 else self._split(at, symbol)
        return new

    def add(self, sequence: Iterable[int], times: int = 1) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            self.seen[last] += times

    def by_length(self) -> list[int]:
        """States, shortest first: every state comes after its suffix link."""
        return sorted(range(len(self.link)), key=self.length.__getitem__)

    def count(self) -> None:
        for state in reversed(self.by_length()[1:]):
            self.seen[self.link[state]] += self.seen[state]

    def matches(self, sequence: Sequence[int]):
        """The matching statistics: at each place, the state and length of the longest match that ends there."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        for symbol in sequence:
            while state and symbol not in moves[state]:
                state = link[state]
                matched = length[state]
            to = moves[state].get(symbol)
            if to is None:
                matched = 0
            else:
                state = to
                matched += 1
            yield state, matched

    def suffix(self, state: int, size: int) -> int:
        """The state that holds the suffix of ``size`` symbols of a match that has at least as many."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


class LongestMatch:
    """Greedy longest-match splitting in one pass over the bytes, without building the pieces.

    The trie of the vocabulary has, for each node, a failure link and the number of pieces that are
    popped on following it: when no edge goes on, the greedy pieces of what was read are counted,
    and the link leads to the node of what is left. Each failure pops a piece or gives up, so the
    time is linear in the bytes.
    """

    def __init__(self, pieces: Iterable[bytes]) -> None:
        edges: dict[int, int] = {}  # node and byte to node
        complete = [False]
        children: list[list[int]] = [[]]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in edges:
                    edges[key] = len(complete)
                    children[node].append(byte)
                    children.append([])
                    complete.append(False)
                node = edges[key]
            complete[node] = complete[node] or node > 0
        fail = [-1] * len(complete)
        popped = [0] * len(complete)
        queue = [0]
        for node in queue:
            for byte in children[node]:
                child = edges[node << 8 | byte]
                queue.append(child)
                if complete[child]:
                    fail[child], popped[child] = 0, 1
                    continue
                at, count = fail[node], popped[node]
                while at >= 0 and at << 8 | byte not in edges:
                    count += popped[at]
                    at = fail[at]
                if at >= 0:
                    fail[child], popped[child] = edges[at << 8 | byte], count
        self.edges, self.fail, self.popped = edges, fail, popped

    def count(self, word: bytes) -> int:
        """Number of pieces, or -1 for a word that greedy matching can't split."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = count = 0
        for byte in word:
            while (to := edges.get(node << 8 | byte)) is None:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = to
        while node > 0:
            count += popped[node]
            node = fail[node]
        return count if node == 0 else -1
