"""Small NumPy helpers that run inside Arrow tasks.

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def depth_norm(n: float) -> float:
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, cut, left, right, adjusted depth) of one isolation tree."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = at
        sub = x[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        open_axes = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) <= 1 or open_axes.size == 0:
            nodes.append([-1, 0.0, -1, -1, depth + depth_norm(len(rows))])
            continue
        axis = int(rng.choice(open_axes))
        cut = float(rng.uniform(lo[axis], hi[axis]))
        if cut >= hi[axis]:  # rounded up between neighbouring numbers; both sides keep a row
            cut = float(lo[axis])
        nodes.append([axis, cut, -1, -1, 0.0])
        left = sub[:, axis] <= cut
        todo.append((rows[~left], depth + 1, at, 1))
        todo.append((rows[left], depth + 1, at, 0))
    return [tuple(n) for n in nodes]
