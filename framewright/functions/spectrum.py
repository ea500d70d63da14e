"""The algebraic connectivity of one connected graph, with a bound on its error."""

from __future__ import annotations

import numpy as np

#: Vectors iterated together: convergence follows the ratio of the second to the sixth eigenvalue.
BLOCK = 4
#: Share of its residual that a solve leaves.
SOLVED = 1e-3
#: Largest relative error of a value that is returned.
ERROR = 1e-6


class Graph:
    """A connected graph of nodes 0 .. n-1, given by the ends of its edges, once each."""

    def __init__(self, i: np.ndarray, j: np.ndarray, n: int):
        self.i, self.j, self.n = i, j, n
        ends, others = np.concatenate([i, j]), np.concatenate([j, i])
        order = np.argsort(ends, kind="stable")
        self.ends, self.others = ends[order], others[order]
        self.at = np.searchsorted(self.ends, np.arange(n + 1))
        self.degree = np.diff(self.at).astype(np.float64)[:, None]
        if n > 1 and not self.degree.all():
            raise ValueError("the graph is not connected")
        far = self._levels(0).argmax()
        self.level = self._levels(far)
        if (self.level < 0).any():
            raise ValueError("the graph is not connected")
        between = self.level[i] != self.level[j]
        self.links = np.bincount(np.minimum(self.level[i], self.level[j])[between], minlength=self.level.max()).astype(np.float64)[:, None]

    def _levels(self, start: int) -> np.ndarray:
        """Edges from the start to each node; -1 where there is no way."""
        level, front, k = np.full(self.n, -1), np.array([start]), 0
        while len(front):
            level[front] = k
            size = self.at[front + 1] - self.at[front]
            near = self.others[np.repeat(self.at[front] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            front, k = np.unique(near[level[near] < 0]), k + 1
        return level

    def times(self, x: np.ndarray) -> np.ndarray:
        """The Laplacian times x, from differences over edges."""
        return np.add.reduceat(x[self.ends] - x[self.others], self.at[:-1])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - (self.degree * x).sum(axis=0) / self.degree.sum()

    def roughly_solved(self, r: np.ndarray) -> np.ndarray:
        """The inverse of the degrees, and of the chain that the graph becomes when the nodes of a level are one; columns of
        r add up to 0."""
        held = np.stack([np.bincount(self.level, c, len(self.links) + 1) for c in r.T], axis=1)
        steps = np.cumsum(held, axis=0)[:-1] / self.links
        heights = np.concatenate([np.zeros((1, r.shape[1])), -np.cumsum(steps, axis=0)])
        return self.centred(r / self.degree + heights[self.level])

    def solved(self, b: np.ndarray, x: np.ndarray, rounds: int) -> np.ndarray:
        """Laplacian x = b by conjugate gradients from a guess."""
        r = b - self.times(x)
        z = self.roughly_solved(r - r.mean(axis=0))
        p, rz = z, (r * z).sum(axis=0)
        goal = SOLVED**2 * rz
        for _ in range(rounds):
            if (rz <= goal).all():
                break
            q = self.times(p)
            step = rz / np.maximum((p * q).sum(axis=0), 1e-300)
            x, r = x + step * p, r - step * q
            z = self.roughly_solved(r - r.mean(axis=0))
            rz, old = (r * z).sum(axis=0), rz
            p = z + rz / np.maximum(old, 1e-300) * p
        return self.centred(x)


def algebraic_connectivity(i: np.ndarray, j: np.ndarray, n: int, rounds: int = 200, solve_rounds: int = 5000) -> float:
    """The second least eigenvalue of the normalised Laplacian of a connected graph (edges i, j once each).

    Inverse iteration of a block of vectors on L u = value D u.  The solves are conjugate gradients preconditioned by degrees and
    by the chain of the graph's levels from an outer node; a chain, the usual match graph of a flight, is that chain itself.
    Values are sums of squared differences over edges, so small ones keep their digits.  It ends when the
    residual r, or r squared over the gap to the next value, bounds the relative error by ``ERROR``, and raises if that is never so."""
    g = Graph(i, j, n)
    k = min(BLOCK, n - 1)
    u, values = g.centred(np.random.default_rng(0).normal(size=(n, k))), np.ones(k)
    for _ in range(rounds):
        u = g.solved(g.degree * u, u / values, solve_rounds)
        u = np.linalg.qr(np.sqrt(g.degree) * u)[0] / np.sqrt(g.degree)
        d = u[i] - u[j]
        values, turn = np.linalg.eigh(d.T @ d)
        u = g.centred(u @ turn)
        first = u[:, :1]
        residual = g.times(first) - values[0] * g.degree * first
        size = float(np.sqrt((residual**2 / g.degree).sum() / (g.degree * first**2).sum()))
        gap = values[1] - values[0] if k > 1 else 0.0
        if min(size, size * size / gap if gap > 0 else size) <= ERROR * values[0]:
            return float(values[0])
    raise ValueError(f"the algebraic connectivity of {n} nodes is not known to {ERROR:g}: residual {size:g} of {values[0]:g}")
