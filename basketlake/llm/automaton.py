"""A suffix automaton of several token sequences, and the longest match that ends at each place of a stream."""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    """Accepts every run of consecutive tokens of the added sequences. State 0 is the empty run."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """The state of the run that is one token longer than p's longest, cut out of q."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, tokens: list[int]) -> None:
        last = 0
        for token in tokens:
            q = self.next[last].get(token)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and token not in self.next[p]:
                self.next[p][token] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][token]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
            last = new

    def stream(self, tokens: list[int]) -> list[tuple[int, int]]:
        """For each token, the state and the length of the longest run of the sequences that ends there."""
        out, state, matched = [], 0, 0
        following, link, length = self.next, self.link, self.length
        for token in tokens:
            to = following[state].get(token)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(token)
            if to is None:
                matched = 0
            else:
                state, matched = to, matched + 1
            out.append((state, matched))
        return out


def known_runs(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of at least so many known tokens; unknown tokens are -1 and end every match."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    keep = ends - starts >= max(1, least)
    return list(zip(starts[keep].tolist(), ends[keep].tolist(), strict=True))


def covered(spans: list[tuple[int, int]], size: int) -> np.ndarray:
    """A mask of the places inside any of the (start, end) spans."""
    steps = np.zeros(size + 1, dtype=np.int64)
    if spans:
        at = np.asarray(spans, dtype=np.int64)
        np.add.at(steps, at[:, 0], 1)
        np.add.at(steps, at[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0
