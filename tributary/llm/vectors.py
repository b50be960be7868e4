"""Integer vectors: which rows hold one, and exact nearest centres.

A component x counts as the integer floor(256 x). Distances are squared and
exact: by blocked matrix products in float64 where no intermediate can reach
2^53, else in 64-bit integers, else in Python's own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of one block of distances.
_CELLS = 1 << 20
#: What a larger distance or sum counts as, so that it fits a long.
MOST = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Whether a vector is there, has components, and none of them is null, not a number or infinite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & whole


def real(table: DataFrame, column: str) -> Column:
    """A column of vectors with components that are float or double."""
    kind = table.schema[column].dataType.elementType.simpleString()
    return F.col(column) if kind in ("float", "double") else F.col(column).cast("array<double>")


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 x), whole numbers as float64; 256 x is exact there, up to 2^1000, which stands for what is beyond."""
    return np.floor(np.clip(x.astype(np.float64), -(2.0**992), 2.0**992) * 256.0)


def _reach(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def nearest(values: np.ndarray, centres: list[list[int]]) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """The number of the nearest centre of each row, the smallest of equally near ones, and its squared distance.

    ``values`` are whole numbers, as int64 or float64. A distance beyond a long counts as MOST.
    """
    reach = _reach(values) + max(abs(x) for c in centres for x in c)
    bound = values.shape[1] * reach * reach  # of the distances and of every partial sum that leads to them
    numbers, distances = [], []
    if bound < 1 << 53:
        c = np.array(centres, np.float64)
        squares = (c * c).sum(1)
    step = max(1, _CELLS // len(centres))
    for at in range(0, len(values), step):
        part = values[at : at + step]
        if bound < 1 << 53:
            x = part.astype(np.float64, copy=False)
            d = ((x * x).sum(1)[:, None] - 2.0 * (x @ c.T) + squares).astype(np.int64)
        elif bound < 1 << 63:
            x = part.astype(np.int64)
            d = np.column_stack([((x - np.array(c, np.int64)) ** 2).sum(1) for c in centres])
        else:
            x = [[int(v) for v in row] for row in part.tolist()]
            whole = [[sum((a - b) ** 2 for a, b in zip(row, c)) for c in centres] for row in x]
            numbers.append(np.array([row.index(min(row)) for row in whole], np.int64))
            distances.append(np.array([min(MOST, min(row)) for row in whole], np.int64))
            continue
        numbers.append(d.argmin(1))
        distances.append(np.take_along_axis(d, numbers[-1][:, None], 1)[:, 0])
    if not numbers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(distances)


def sums_by(numbers: np.ndarray, values: np.ndarray, weights: np.ndarray | None = None) -> dict[int, tuple[int, list[int]]]:
    """By number: how many rows have it (each as often as its weight) and the exact sums of their components."""
    if not len(numbers):
        return {}
    weights = np.ones(len(numbers), np.int64) if weights is None else weights
    order = np.argsort(numbers, kind="stable")
    own, starts = np.unique(numbers[order], return_index=True)
    counts = np.add.reduceat(weights[order], starts)
    if _reach(values) * int(weights.sum()) < 1 << 63:
        sums = np.add.reduceat(values[order].astype(np.int64) * weights[order][:, None], starts, axis=0)
        return {int(k): (int(n), row) for k, n, row in zip(own, counts, sums.tolist())}
    out = {}
    for k, n, at, end in zip(own, counts, starts, [*starts[1:], len(order)]):
        rows = [([int(v) for v in values[i].tolist()], int(weights[i])) for i in order[at:end]]
        out[int(k)] = (int(n), [sum(v[j] * w for v, w in rows) for j in range(values.shape[1])])
    return out


def moved(centres: list[list[int]], sums: dict[int, tuple[int, list[int]]]) -> list[list[int]]:
    """The centres after a round: floor(sum / count) by components, where there are rows; others stay."""
    return [[s // sums[k][0] for s in sums[k][1]] if k in sums else c for k, c in enumerate(centres)]


def as_long(total: Column) -> Column:
    """A decimal sum as a long; MOST where it is beyond."""
    return F.least(total, F.lit(MOST).cast("decimal(38,0)")).cast("long")
