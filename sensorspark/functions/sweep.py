"""Best overlap between two sets of intervals, without making their pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Intervals of a block.
BLOCK = 64


class Boxes:
    """Intervals packed into blocks that are close in start and in end, with the bounds of each block."""

    def __init__(self, start: np.ndarray, end: np.ndarray, position: np.ndarray, size: int = BLOCK):
        n = len(start)
        slabs = max(1, round((n / size) ** 0.5))
        slab = np.empty(n, np.int64)
        slab[np.lexsort((end, start))] = np.arange(n) * slabs // max(n, 1)
        self.order = np.lexsort((start, end, slab))
        self.start, self.end, self.position = start[self.order], end[self.order], position[self.order]
        self.at = np.arange(0, n, size)
        self.to = np.minimum(self.at + size, n)
        length = self.end - self.start
        self.low, self.high = (f.reduceat(self.start, self.at) for f in (np.minimum, np.maximum))
        self.first, self.last = (f.reduceat(self.end, self.at) for f in (np.minimum, np.maximum))
        self.short, self.long = (f.reduceat(length, self.at) for f in (np.minimum, np.maximum))
        self.least = np.minimum.reduceat(self.position, self.at)

    def bound(self, other: Boxes, i: int) -> np.ndarray:
        """No interval of block ``i`` of ``other`` has a larger IoU with one of each block than this."""
        shared = np.minimum(self.last, other.last[i]) - np.maximum(self.low, other.low[i])
        shared = np.minimum(shared, np.minimum(self.long, other.long[i]))
        # The union holds both, and each is at least as long as the shortest of its block.
        hull = np.maximum(self.first, other.first[i]) - np.minimum(self.high, other.high[i])
        union = np.maximum(np.maximum(hull, self.short + other.short[i] - shared), np.maximum(self.short, other.short[i]))
        # The bound is an estimate in floating point; a little room keeps it one.
        return np.where(shared > 0, np.minimum(shared / union, 1.0), 0.0) * (1 + 1e-9)

    def blocks(self) -> Iterator[slice]:
        for a, b in zip(self.at.tolist(), self.to.tolist()):
            yield slice(a, b)


def best_overlap(
    start: np.ndarray, end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray, b_position: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``(iou, index)`` of the best ``b`` of every interval; index -1 where nothing overlaps.

    Ties go to the smallest position.  Blocks of ``b`` are visited by falling bound until no
    bound reaches the worst best of the block that asks.  Lengths must be positive.
    """
    iou, index = np.zeros(len(start)), np.full(len(start), -1, np.int64)
    if not len(start) or not len(b_start):
        return iou, index
    # Positions as ranks, so that any type of number compares exactly.
    rank = np.empty(len(b_start), np.int64)
    rank[np.argsort(b_position, kind="stable")] = np.arange(len(b_start))
    a, b = Boxes(start, end, np.zeros(len(start), np.int64)), Boxes(b_start, b_end, rank)
    parts = list(b.blocks())
    for i, own in enumerate(a.blocks()):
        s, e = a.start[own, None], a.end[own, None]
        best, place, pick = np.zeros(own.stop - own.start), np.full(own.stop - own.start, len(rank)), np.full(own.stop - own.start, -1)
        bound = b.bound(a, i)
        some = np.flatnonzero(bound > 0)
        for j in some[np.argsort(-bound[some], kind="stable")].tolist():
            worst = best.min()
            if bound[j] < worst:
                break
            if not ((bound[j] > best) & ((bound[j] > best * (1 + 4e-9)) | (b.least[j] < place))).any():
                continue
            part = parts[j]
            bs, be = b.start[None, part], b.end[None, part]
            shared = np.minimum(e, be) - np.maximum(s, bs)
            value = np.where(shared > 0, shared / ((e - s) + (be - bs) - shared), 0.0)
            top = value.max(axis=1)
            ranks = np.where(value == top[:, None], b.position[None, part], len(rank))
            at = ranks.argmin(axis=1)
            won = (top > best) | ((top == best) & (top > 0) & (ranks.min(axis=1) < place))
            best[won], place[won], pick[won] = top[won], ranks.min(axis=1)[won], b.order[part][at[won]]
        iou[a.order[own]], index[a.order[own]] = best, pick
    return iou, index
