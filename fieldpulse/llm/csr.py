"""Sparse matrices of whole numbers in compressed rows."""

from __future__ import annotations

import numpy as np


class Csr:
    """``columns[starts[i]:starts[i + 1]]`` and ``values`` of the same places are row i, columns ascending."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.columns, self.values, self.width = starts, columns, values, width

    def __len__(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> Csr:
        """From entries in any order; those of one place are added up."""
        key = rows.astype(np.int64) * shape[1] + columns
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        total = np.add.reduceat(values, first) if len(first) else values
        rows, columns = np.divmod(key[first], max(shape[1], 1))
        starts = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=shape[0]))))
        return cls(starts, columns, total, shape[1])

    @classmethod
    def tiles(cls, sizes: np.ndarray) -> Csr:
        """Row i has ones in the ``sizes[i]`` columns that follow those of row i - 1."""
        starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        n = int(starts[-1])
        return cls(starts, np.arange(n), np.ones(n, np.int64), n)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def transposed(self) -> Csr:
        return Csr.of(self.columns, self.rows(), self.values, (self.width, len(self)))

    def picked(self, rows: np.ndarray) -> Csr:
        """The matrix of these rows, in this order."""
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Csr(starts, self.columns[at], self.values[at], self.width)

    def times(self, other: Csr) -> Csr:
        """The product, by Gustavson: row i is the sum of the rows of ``other`` that row i names,
        each times its value."""
        parts = other.picked(self.columns)
        sizes = np.diff(parts.starts)
        rows = np.repeat(self.rows(), sizes)
        return Csr.of(rows, parts.columns, np.repeat(self.values, sizes) * parts.values, (len(self), other.width))

    def applied(self, vector: np.ndarray) -> np.ndarray:
        """The product with a column."""
        return np.bincount(self.rows(), self.values * vector[self.columns], len(self)) if len(self) else np.empty(0)
