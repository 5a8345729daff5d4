"""K2-treap: a compressed quadtree over a sparse grid whose cells store the largest value below them.

The grid is halved in both directions level by level. Only cells with a value below them exist; each has four bits that
tell which of its quarters exist, and the rank of a bit in its level is the place of that quarter, so no pointers are
stored but the place of each cell's first quarter. The largest value of every cell is kept beside its bits.

:meth:`K2Treap.best` descends the paths of several rows at once, best first over ranges of columns. A range carries, for
every row, the cell that covers the row's part of it; the weighted sum of the cells' maxima bounds the score of all its
columns and is exact for a range of one column. Ranges are opened in order of their bounds, many at a time so that numpy
does the work; a range whose bound is below the score of the last place is never opened, one that ties with it is.
"""

from __future__ import annotations

import numpy as np

_BITS = np.array([bin(i).count("1") for i in range(16)], np.int8)
_WAVE = 1024


class K2Treap:
    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> None:
        """Values at distinct places of the grid, all above 0."""
        side = max(int(rows.max(initial=0)), int(columns.max(initial=0)), 1)
        self.height = side.bit_length()
        place = np.zeros(len(rows), np.int64)
        for bit in range(self.height):  # interleaved bits: the first two tell the quarter of the root
            place |= ((rows >> bit) & 1).astype(np.int64) << (2 * bit + 1) | ((columns >> bit) & 1).astype(np.int64) << (2 * bit)
        order = np.argsort(place)
        place, values = place[order], np.asarray(values, np.int64)[order]
        levels = [(np.zeros(len(place), np.int8), values)]
        while len(levels) <= self.height:
            quarter, place = (place & 3).astype(np.int64), place >> 2
            starts = np.flatnonzero(np.diff(place, prepend=-1)) if len(place) else np.zeros(0, np.int64)
            bits = np.bitwise_or.reduceat(1 << quarter, starts) if len(starts) else starts
            values = np.maximum.reduceat(values, starts) if len(starts) else values
            levels.append((bits.astype(np.int8), values))
            place = place[starts]
        levels.reverse()
        self.cells = np.concatenate([bits for bits, _ in levels])
        self.most = np.concatenate([values for _, values in levels])
        ends = np.cumsum(_BITS[self.cells], dtype=np.int32)
        self.first = ends - _BITS[self.cells] + 1

    def best(self, rows: np.ndarray, weights: np.ndarray, wanted: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the ``wanted`` columns of the highest scores of at least ``least``, ties by column.

        A column's score is the sum of its values in ``rows``, each times the row's weight.
        """
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(rows) or not len(self.cells):
            return found, scores
        rows, weights = rows.astype(np.int64), weights.astype(np.int64)
        # Ranges not opened yet: level, first column in units of its width, bound, and a cell per row (-1: nothing there).
        level, prefix = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = np.array([(self.most[0] * weights).sum()])
        cells = np.zeros((1, len(rows)), np.int64)
        while len(level):
            if len(level) > _WAVE:
                now = np.argpartition(-bound, _WAVE)[:_WAVE]
                later = np.ones(len(level), bool)
                later[now] = False
            else:
                now, later = slice(None), np.zeros(len(level), bool)
            opened = level[now], prefix[now], cells[now]
            level, prefix, bound, cells = level[later], prefix[later], bound[later], cells[later]
            new = self._open(rows, weights, *opened)
            single = new[0] == self.height
            if single.any():
                found, scores = np.concatenate([found, new[1][single]]), np.concatenate([scores, new[2][single]])
                top = np.lexsort((found, -scores))[:wanted]
                found, scores = found[top], scores[top]
                if len(scores) == wanted:
                    least = max(least, int(scores[-1]))
            level, prefix, bound, cells = (
                np.concatenate([old, part[~single]]) for old, part in zip((level, prefix, bound, cells), new, strict=True)
            )
            hope = bound >= least
            if not hope.all():
                level, prefix, bound, cells = level[hope], prefix[hope], bound[hope], cells[hope]
        keep = scores >= least
        return found[keep], scores[keep]

    def _open(
        self, rows: np.ndarray, weights: np.ndarray, level: np.ndarray, prefix: np.ndarray, cells: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both halves of every range, as in :meth:`best`."""
        bits = np.where(cells >= 0, self.cells[cells], 0)
        first = self.first[cells]
        quarter = 2 * ((rows[None, :] >> (self.height - 1 - level)[:, None]) & 1)
        parts = []
        for half in (0, 1):
            bit = 1 << (quarter + half)
            below = np.where(bits & bit, first + _BITS[bits & (bit - 1)], -1)
            bound = np.where(below >= 0, self.most[below], 0) @ weights
            parts.append((level + 1, 2 * prefix + half, bound, below))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
