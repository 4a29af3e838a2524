"""Suffix order of one shard by external induced sorting.

The text is a string of numbers below ``SIGMA`` (0 separates its parts). A suffix is of type S if
it is smaller than the one after it, else of type L; an S suffix after an L suffix is leftmost.

* Leftmost suffixes are put under their first character and all other suffixes are induced from
  them in two sweeps: a monotone priority queue holds (first character, arrival) and hands out
  suffixes in order; each one sends the suffix in front of it to that one's first character.
  Queues are lists of blocks that go to a scratch file when memory is used up.
* The sweep sorts the leftmost substrings. Equal ones get one name, and the string of names (at
  most half as long) is sorted in turn: names that still tie are refined with the name that
  follows, 2, 4, ... names on, until they differ or ``depth`` characters are equal.
* A second induction with the leftmost suffixes in their final order gives the order of all.

Only the first ``depth`` characters are ordered; suffixes that share them come in some order. The
scratch file belongs to the task and goes with it; a task that is run again starts anew.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

SIGMA = 257


class Spool:
    """Arrays of positions, in memory up to ``limit`` bytes and in a scratch file beyond."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.file = tempfile.TemporaryFile()

    def put(self, block: np.ndarray):
        if self.held + block.nbytes <= self.limit:
            self.held += block.nbytes
            return block
        at = self.file.seek(0, 2)
        self.file.write(block.tobytes())
        return at, len(block)

    def get(self, block) -> np.ndarray:
        if isinstance(block, tuple):
            self.file.seek(block[0])
            return np.frombuffer(self.file.read(8 * block[1]), np.int64)
        return block

    def close(self) -> None:
        self.file.close()


class Buckets:
    """One first-in-first-out queue per first character."""

    def __init__(self, spool: Spool):
        self.spool, self.blocks = spool, [[] for _ in range(SIGMA)]

    def add(self, text: np.ndarray, suffixes: np.ndarray) -> None:
        if not len(suffixes):
            return
        chars = text[suffixes]
        order = np.argsort(chars, kind="stable")
        chars, suffixes = chars[order], suffixes[order]
        cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
        for s, e in zip([0, *cuts], [*cuts, len(chars)]):
            self.blocks[chars[s]].append(self.spool.put(suffixes[s:e].copy()))

    def drain(self, char: int, chunk: int) -> Iterator[np.ndarray]:
        """Blocks in order of arrival, those that arrive meanwhile included; small ones joined."""
        at = 0
        while at < len(self.blocks[char]):
            part, size = [], 0
            while at < len(self.blocks[char]) and size < chunk:
                part.append(self.spool.get(self.blocks[char][at]))
                size += len(part[-1])
                at += 1
            yield np.concatenate(part) if len(part) > 1 else part[0]

    def backwards(self, char: int) -> Iterator[np.ndarray]:
        for block in reversed(self.blocks[char]):
            yield self.spool.get(block)[::-1]


def leftmost(text: np.ndarray) -> np.ndarray:
    """Positions of the leftmost S suffixes; the last position (a separator) is one."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    smaller = text[change] < text[change + 1]
    # A position takes the type of the next place where the text changes; the last one is S.
    runs = np.diff(np.concatenate([[-1], change, [n - 1]]))
    is_s = np.repeat(np.append(smaller, True), runs)
    return np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1


def induce(text: np.ndarray, starts: np.ndarray, spool: Spool, chunk: int
           ) -> tuple[Buckets, Buckets]:
    """(L, S) queues: L suffixes ascending and S suffixes descending, per first character."""
    seeds, low, high = Buckets(spool), Buckets(spool), Buckets(spool)
    seeds.add(text, starts)
    for c in range(SIGMA):
        for part in low.drain(c, chunk):
            before = part[part > 0] - 1
            low.add(text, before[text[before] >= c])
        for part in seeds.drain(c, chunk):
            before = part[part > 0] - 1
            low.add(text, before[text[before] > c])
    # The last separator has no suffix after it and is the smallest one.
    for c in reversed(range(SIGMA)):
        for part in high.drain(c, chunk):
            before = part[part > 0] - 1
            high.add(text, before[text[before] <= c])
        for part in low.backwards(c):
            before = part[part > 0] - 1
            high.add(text, before[text[before] < c])
    return low, high


def substring_names(text: np.ndarray, order: np.ndarray, starts: np.ndarray, depth: int
                    ) -> np.ndarray:
    """Names of the leftmost substrings in text order; ``order`` has them sorted."""
    place = np.searchsorted(starts, order)
    ends = np.append(starts[1:], starts[-1])
    length = (ends - starts)[place]
    same = length[1:] == length[:-1]
    pair = np.flatnonzero(same)
    for d in range(depth + 1):
        pair = pair[d <= length[pair]]
        if not len(pair):
            break
        differ = text[order[pair] + d] != text[order[pair + 1] + d]
        same[pair[differ]] = False
        pair = pair[~differ]
    names = np.empty(len(starts), np.int64)
    names[place] = np.concatenate([[0], np.cumsum(~same)])
    return names


def order_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names``; a name stands for two characters or more."""
    n = len(names)
    count = np.bincount(names)
    rank = (np.cumsum(count) - count)[names]  # first place of the name
    tied = np.flatnonzero(count[names] > 1)
    step = 1
    while len(tied) and 2 * step < depth + 2:
        after = tied + step
        follow = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        by = np.lexsort((follow, rank[tied]))
        tied, follow = tied[by], follow[by]
        group = rank[tied]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_name = new_group | np.concatenate([[True], follow[1:] != follow[:-1]])
        at = np.arange(len(tied))
        group_start = np.maximum.accumulate(np.where(new_group, at, 0))
        name_start = np.maximum.accumulate(np.where(new_name, at, 0))
        rank[tied] = group + name_start - group_start
        alone = new_name & np.append(new_name[1:], True)
        tied = np.sort(tied[~alone])
        step *= 2
    return np.argsort(rank, kind="stable")


def suffix_order(text: np.ndarray, depth: int, memory: int = 1 << 26, chunk: int = 1 << 20
                 ) -> Iterator[np.ndarray]:
    """Blocks of suffix positions in ascending order of their first ``depth`` characters.

    ``text`` must end with 0.
    """
    starts = leftmost(text)
    spool = Spool(memory)
    try:
        if len(starts):
            is_start = np.zeros(len(text), bool)
            is_start[starts] = True
            _, high = induce(text, starts, spool, chunk)
            found = [part[is_start[part]] for c in range(SIGMA) for part in high.backwards(c)]
            # The last separator is induced by nothing; it comes first of all.
            order = np.concatenate([starts[-1:], *found])
            names = substring_names(text, order, starts, depth)
            if names.max() + 1 < len(names):
                order = starts[order_names(names, depth)]
        else:
            order = starts
        spool.close()
        spool = Spool(memory)
        low, high = induce(text, order, spool, chunk)
        yield np.array([len(text) - 1], np.int64)
        for c in range(SIGMA):
            yield from low.drain(c, chunk)
            yield from high.backwards(c)
    finally:
        spool.close()
