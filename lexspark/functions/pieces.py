"""Greedy longest matching of sub-word pieces by a trie, for whole batches of words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_CODE_BITS = 21
WHOLE, REST = 0, 1


@dataclass
class Trie:
    """Pieces as sorted arrays: ``keys`` holds parent * 2**21 + character of every node but the roots.

    Node 0 is the root of pieces that begin a word, node 1 that of the others; the node of ``keys[i]`` is
    ``i + 2``. ``ends`` tells the nodes at which a piece ends.
    """

    keys: np.ndarray
    ends: np.ndarray

    def child(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node below by a character, -1 if there is none."""
        wanted = nodes << _CODE_BITS | codes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1) if len(self.keys) else None
        return np.full(len(nodes), -1) if at is None else np.where(self.keys[at] == wanted, at + 2, -1)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, and the number of each."""
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return joined, np.fromiter(map(len, texts), np.int64, len(texts))


def build_trie(whole: list[str], rest: list[str]) -> Trie:
    """The trie of pieces that begin a word and of those that do not, level by level."""
    codes, sizes = _codes(whole + rest)
    starts = np.cumsum(sizes) - sizes
    node = np.repeat([WHOLE, REST], [len(whole), len(rest)])
    open_ = np.flatnonzero(sizes > 0)
    keys, ending, depth, made = [], [], 0, 2
    while len(open_):
        wanted = node[open_] << _CODE_BITS | codes[starts[open_] + depth]
        level, at = np.unique(wanted, return_inverse=True)
        keys.append(level)
        node[open_] = at + made
        made += len(level)
        depth += 1
        ending.append(node[open_[sizes[open_] == depth]])
        open_ = open_[sizes[open_] > depth]
    ends = np.zeros(made, bool)
    for nodes in ending:
        ends[nodes] = True
    # nodes are numbered level by level, and keys grow with the parent's number: they are sorted as they come
    return Trie(np.concatenate(keys) if keys else np.empty(0, np.int64), ends)


def match(words: list[str], trie: Trie) -> list[list[tuple[int, int]] | None]:
    """Per word the (start, end) of its pieces: from the left, each the longest; None where none fits.

    All words of the batch step on together, one character at a time.
    """
    codes, sizes = _codes(words)
    first = np.cumsum(sizes) - sizes
    n = len(words)
    start, at, best, node = (np.zeros(n, np.int64) for _ in range(4))
    failed = sizes == 0
    found_row, found_start, found_end = [], [], []
    active = np.flatnonzero(~failed)
    while len(active):
        inside = at[active] < sizes[active]
        below = np.full(len(active), -1)
        rows = active[inside]
        below[inside] = trie.child(node[rows], codes[first[rows] + at[rows]])
        on = below >= 0
        rows = active[on]
        node[rows], at[rows] = below[on], at[rows] + 1
        ends = rows[trie.ends[below[on]]]
        best[ends] = at[ends]
        # the others end a piece, or fail if none ended since it began
        rows = active[~on]
        lost = rows[best[rows] == start[rows]]
        failed[lost] = True
        cut = rows[best[rows] > start[rows]]
        found_row.append(cut)
        found_start.append(start[cut])
        found_end.append(best[cut])
        start[cut] = at[cut] = best[cut]
        node[cut] = REST
        active = np.concatenate([active[on], cut[start[cut] < sizes[cut]]])
    row, begin, end = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (found_row, found_start, found_end))
    order = np.lexsort((begin, row))
    row, begin, end = row[order], begin[order].tolist(), end[order].tolist()
    bounds = np.searchsorted(row, np.arange(n + 1)).tolist()
    return [None if failed[i] else list(zip(begin[bounds[i]:bounds[i + 1]], end[bounds[i]:bounds[i + 1]], strict=True))
            for i in range(n)]
