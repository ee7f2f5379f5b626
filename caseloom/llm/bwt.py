"""Burrows-Wheeler transforms of string sets, and their merge by iterative interleave refinement.

A shard is a set of byte strings with its suffix order, its transform (the byte before each suffix) and the mapping
from each suffix to the one that starts a byte earlier. Merging starts from the shards laid end to end and refines
the interleave: a stable sort of the current order by transform symbol, followed by that mapping, turns an order by
the first h bytes into one by the first h + 1. Suffixes are never sorted again. Neighbours part in the round that
first tells them apart, so the round number is the length of their common prefix, and the blocks left after round
``depth`` are the repeated intervals: all places that share a string of that length.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """Suffixes of ``strings`` in order: ``owner`` and ``offset`` of each, ``bwt`` (0: string start, else byte + 1),
    ``before`` (place of the suffix one byte earlier; -1 at a string start). Each string ends in a mark that is smaller
    than every byte; suffixes equal to their marks are in the order of their strings."""

    def __init__(self, strings: list[bytes]):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
        n = int(lengths.sum())
        first = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
        text[first + lengths - 1] = 0
        owner = np.repeat(np.arange(len(strings)), lengths)
        left = np.repeat(first + lengths - 1, lengths) - np.arange(n)  # bytes before the mark
        order = self._sorted(text, left, int(lengths.max(initial=0)))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        start = np.zeros(n, bool)
        start[first] = True
        self.owner, self.offset = owner[order].astype(np.int32), (order - first[owner[order]]).astype(np.int32)
        self.bwt = np.where(start[order], 0, text[order - 1]).astype(np.uint16)
        self.before = np.where(start[order], -1, place[order - 1]).astype(np.int32)

    @staticmethod
    def _sorted(text: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
        """First by seven symbols at once; then only suffixes that still tie are sorted on, by the rank of what follows
        the part they share, which doubles each time."""
        n, width = len(text), 7
        key, padded = np.zeros(n, np.uint64), np.concatenate((text, np.zeros(width, np.uint16))).astype(np.uint64)
        for j in range(width):
            key |= padded[j : j + n] << np.uint64(9 * (width - 1 - j))
        short = left < width - 1
        key[short] &= ~np.uint64(0) << (np.uint64(9) * (width - 1 - left[short]).astype(np.uint64))  # nothing counts after the mark
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))[:n]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        reach = width
        while reach <= longest:
            tied = np.flatnonzero(~new | np.append(~new[1:], False))
            tied = tied[left[order[tied]] >= reach]
            if not len(tied):
                break
            at = order[tied]
            both = rank[at] * n + rank[at + reach]
            turn = np.argsort(both, kind="stable")
            order[tied], both = at[turn], both[turn]
            parts = np.concatenate(([True], both[1:] != both[:-1]))
            new[tied] = parts
            rank[order[tied]] = np.maximum.accumulate(np.where(parts, tied, 0))
            reach *= 2
        return order


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard of each row, row in the shard, block) after ``depth`` rounds; rows of a block share ``depth`` bytes.

    Rounds start from the suffixes at least ``depth`` bytes into their string: those alone are still in it after the
    last round. A suffix that is alone with its first h bytes leaves, as everything before it will be alone too.
    """
    base = np.cumsum([0, *[len(s.bwt) for s in shards]])
    bwt = np.concatenate([s.bwt for s in shards])
    before = np.concatenate([s.before + b for s, b in zip(shards, base[:-1].tolist(), strict=True)]).astype(np.int32)
    order = np.flatnonzero(np.concatenate([s.offset for s in shards]) >= depth).astype(np.int32)
    block = np.zeros(len(order), np.int32)
    for _ in range(depth):
        if not len(order):
            break
        symbol = bwt[order]
        turn = np.argsort(symbol, kind="stable")
        symbol, block = symbol[turn], block[turn]
        order = before[order[turn]]
        new = np.empty(len(order), bool)
        new[0] = True
        np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
        new[1:] |= block[1:] != block[:-1]
        stay = ~(new & np.append(new[1:], True))
        if not stay.all():
            order, new = order[stay], new[stay]
        block = np.cumsum(new, dtype=np.int32)
    shard = np.searchsorted(base, order, side="right") - 1
    return shard, order - base[shard], block


def repeated_intervals(strings: list[bytes], depth: int, shard_bytes: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, block) of all places whose ``depth`` bytes occur at another place too; a block is one such
    interval of the merged transform. Strings are dealt to shards in turn, so likes start in different shards."""
    total = sum(map(len, strings))
    k = max(1, min(len(strings), -(-total // shard_bytes)))
    parts = [list(range(j, len(strings), k)) for j in range(k)]
    shards = [Shard([strings[i] for i in part]) for part in parts]
    shard, row, block = merge(shards, depth)
    string, offset = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
    for j, (s, part) in enumerate(zip(shards, parts, strict=True)):
        here = shard == j
        string[here] = np.array(part, np.int64)[s.owner[row[here]]]
        offset[here] = s.offset[row[here]]
    return string, offset, block
