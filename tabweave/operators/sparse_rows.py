"""Rows given by the positions and values of their elements, and the products a first layer needs of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_GATHERED = 1 << 21  # numbers that a product holds at a time


@dataclass(frozen=True)
class ColumnGradient:
    """Gradient of a weight matrix that is zero outside some columns."""

    columns: np.ndarray
    values: np.ndarray


class SparseRows:
    """A batch of rows; row ``i`` has the elements from ``starts[i]`` to ``starts[i + 1]``, all others are zero."""

    def __init__(self, positions: np.ndarray, values: np.ndarray, starts: np.ndarray):
        self.positions, self.values, self.starts = positions, values, starts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __getitem__(self, rows: slice) -> SparseRows:
        first, last, _ = rows.indices(len(self))
        last = max(first, last)
        a, b = int(self.starts[first]), int(self.starts[last])
        return SparseRows(self.positions[a:b], self.values[a:b], self.starts[first : last + 1] - a)

    @classmethod
    def concatenate(cls, parts: Sequence[SparseRows]) -> SparseRows:
        lengths = np.concatenate([np.diff(p.starts) for p in parts])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return cls(np.concatenate([p.positions for p in parts]), np.concatenate([p.values for p in parts]), starts)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The product with a matrix of one line per unit, a bounded number of elements at a time."""
        units = len(weights)
        out = np.zeros((len(self), units))
        by_position = weights.T
        longest = max(1, _GATHERED // max(units, 1))
        filled = np.flatnonzero(np.diff(self.starts))
        at = 0
        while at < len(filled):
            begin = self.starts[filled[at]]
            to = max(at + 1, int(np.searchsorted(self.starts[filled + 1], begin + longest, side="right")))
            rows = filled[at:to]
            end = self.starts[rows[-1] + 1]
            parts = by_position[self.positions[begin:end]] * self.values[begin:end, None]
            out[rows] = np.add.reduceat(parts, self.starts[rows] - begin, axis=0)
            at = to
        return out

    def gradient(self, d_out: np.ndarray) -> ColumnGradient:
        """Gradient of the weights for the gradient at the outputs: only columns that some row has an element in."""
        order = np.argsort(self.positions, kind="stable")
        ordered = self.positions[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else order
        owner = np.repeat(np.arange(len(self)), np.diff(self.starts))[order]
        values = np.zeros((d_out.shape[1], len(first)))
        for unit in range(d_out.shape[1] if len(first) else 0):
            values[unit] = np.add.reduceat(d_out[owner, unit] * self.values[order], first)
        return ColumnGradient(ordered[first], values)

    def renumbered(self, known: np.ndarray) -> SparseRows:
        """The same rows over the positions ``known`` (ascending, with all that occur) instead of all positions."""
        return SparseRows(np.searchsorted(known, self.positions), self.values, self.starts)


Features = str | tuple[str, str]


def feature_names(features: Features) -> tuple[str, ...]:
    """The columns that hold the features: one array of all elements, or positions and values."""
    return (features,) if isinstance(features, str) else tuple(features)


def feature_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix, without a Python object per row."""
    values = column.flatten()
    if column.null_count or len(values) != len(column) * width or values.null_count:
        raise ValueError(f"features must be arrays of {width} numbers without nulls")
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _sparse_rows(positions: pa.Array, values: pa.Array, width: int) -> SparseRows:
    flat = [c.flatten() for c in (positions, values)]
    lengths = [pa.compute.list_value_length(c) for c in (positions, values)]
    if any(c.null_count for c in (positions, values, *flat)) or not lengths[0].equals(lengths[1]):
        raise ValueError("positions and values must be arrays of one length without nulls")
    at = flat[0].to_numpy(zero_copy_only=False).astype(np.int64)
    if len(at) and not (0 <= at.min() and at.max() < width):
        raise ValueError(f"positions must lie between 0 and {width - 1}")
    starts = np.concatenate([[0], np.cumsum(lengths[0].to_numpy(zero_copy_only=False), dtype=np.int64)])
    return SparseRows(at, flat[1].to_numpy(zero_copy_only=False).astype(np.float64), starts)


def read_features(batch: pa.RecordBatch, features: Features, width: int) -> np.ndarray | SparseRows:
    """The feature rows of an Arrow batch in either form."""
    columns = [batch.column(batch.schema.get_field_index(c)) for c in feature_names(features)]
    return feature_matrix(columns[0], width) if len(columns) == 1 else _sparse_rows(*columns, width)


def stack(parts: Sequence[np.ndarray | SparseRows]) -> np.ndarray | SparseRows:
    if len(parts) == 1:
        return parts[0]
    return SparseRows.concatenate(parts) if isinstance(parts[0], SparseRows) else np.concatenate(parts)
