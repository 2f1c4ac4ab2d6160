"""A small gradient-boosted tree classifier (logistic loss, binned features)."""

from __future__ import annotations

import numpy as np

#: Gradients are summed as whole multiples of 1 / SCALE.
SCALE = 2.0**24


class BoostedTrees:
    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, leaf: float = 5.0, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.leaf, self.ridge = rounds, depth, rate, bins, leaf, ridge
        self.edges: list[np.ndarray] = []
        self.trees: list[list] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)[:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            tree: list = []
            self._grow(b, grad, hess, np.arange(len(y)), self.depth, tree)
            self.trees.append(tree)
            score += self._walk(tree, b)
        return self

    def _grow(self, b, grad, hess, rows, depth, tree) -> int:
        """Append the node of these rows; a node is (feature, bin, left, right) or (value,)."""
        me = len(tree)
        g, h = grad[rows].sum(), hess[rows].sum()
        tree.append((self.rate * g / (h + self.ridge),))
        if depth == 0 or len(rows) < 2 * self.leaf:
            return me
        best, choice = 1e-6, None
        for j in range(b.shape[1]):
            size = len(self.edges[j]) + 1
            gs = np.cumsum(np.bincount(b[rows, j], grad[rows], size))[:-1]
            hs = np.cumsum(np.bincount(b[rows, j], hess[rows], size))[:-1]
            ns = np.cumsum(np.bincount(b[rows, j], minlength=size))[:-1]
            gain = gs**2 / (hs + self.ridge) + (g - gs) ** 2 / (h - hs + self.ridge) - g**2 / (h + self.ridge)
            gain[(ns < self.leaf) | (len(rows) - ns < self.leaf)] = 0
            if len(gain) and gain.max() > best:
                best, choice = gain.max(), (j, int(gain.argmax()))
        if choice:
            left = b[rows, choice[0]] <= choice[1]
            l = self._grow(b, grad, hess, rows[left], depth - 1, tree)
            r = self._grow(b, grad, hess, rows[~left], depth - 1, tree)
            tree[me] = (*choice, l, r)
        return me

    def fit_spread(self, parts) -> BoostedTrees:
        """fit over an RDD of pairs (x, y) of arrays: the same trees but for rounding, grown level by level.

        Bins come from the counts of all values (features with few distinct ones), splits from histograms
        that tasks make of their rows and Spark sums up. Sums are of whole numbers, so no order changes them."""
        def merged(a, b):
            out = []
            for (u, n), (v, m) in zip(a, b, strict=True):
                w, at = np.unique(np.concatenate([u, v]), return_inverse=True)
                out.append((w, np.bincount(at, np.concatenate([n, m]), len(w)).astype(np.int64)))
            return out

        counts = parts.map(lambda p: [np.unique(c, return_counts=True) for c in [*p[0].T, p[1]]]).treeReduce(merged)
        labels = counts.pop()
        n = int(labels[1].sum())
        for u, c in counts:
            at, end = np.linspace(0, 1, self.bins)[:-1] * (n - 1), np.cumsum(c)
            low, high = (u[np.searchsorted(end, k(at), "right")] for k in (np.floor, np.ceil))
            self.edges.append(np.unique(low + (high - low) * (at - np.floor(at))))
        rate = np.clip(float(labels[0] @ labels[1]) / n, 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        binned = parts.map(lambda p, edges=self.edges: (np.stack([np.searchsorted(e, p[0][:, j], "left") for j, e in enumerate(edges)], 1).astype(np.uint8), p[1])).cache()
        size = max(map(len, self.edges)) + 1
        for _ in range(self.rounds):
            tree, open_nodes = [(0.0,)], [0]
            for level in range(self.depth):
                sums = binned.map(self._histograms(list(tree), open_nodes, size)).treeReduce(np.add).astype(float)
                sums[..., :2] /= SCALE
                if not level:
                    g, h, _ = sums[0, 0].sum(0)
                    tree[0] = (self.rate * g / (h + self.ridge),)
                grown = []
                for at, own in zip(open_nodes, sums, strict=True):
                    if (choice := self._split(own)) is None:
                        continue
                    left = own[choice[0], : choice[1] + 1].sum(0)
                    for g, h, _ in (left, own[choice[0]].sum(0) - left):
                        grown.append(len(tree))
                        tree.append((self.rate * g / (h + self.ridge),))
                    tree[at] = (*choice, grown[-2], grown[-1])
                open_nodes = grown
                if not grown:
                    break
            self.trees.append(tree)
        binned.unpersist()
        return self

    def _histograms(self, tree, nodes, size):
        start, trees, walk = self.start, list(self.trees), self._walk

        def run(part):
            b, y = part
            p = 1 / (1 + np.exp(-sum((walk(t, b) for t in trees), np.full(len(y), start))))
            grad, hess = np.rint((y - p) * SCALE), np.rint(np.maximum(p * (1 - p), 1e-6) * SCALE)
            place = walk([(k,) if len(t) == 1 else t for k, t in enumerate(tree)], b)
            out = np.zeros((len(nodes), b.shape[1], size, 3), np.int64)
            for i, k in enumerate(nodes):
                rows = np.flatnonzero(place == k)
                for j in range(b.shape[1]):
                    for z, weights in enumerate((grad[rows], hess[rows], None)):
                        out[i, j, :, z] = np.bincount(b[rows, j], weights, size)
            return out

        return run

    def _split(self, sums):
        """(feature, bin) of the best split of a node's histograms (feature, bin, gradient hessian count), or None."""
        g, h, n = sums[0].sum(0)
        if n < 2 * self.leaf:
            return None
        gs, hs, ns = np.moveaxis(np.cumsum(sums, 1)[:, :-1], 2, 0)
        gain = gs**2 / (hs + self.ridge) + (g - gs) ** 2 / (h - hs + self.ridge) - g**2 / (h + self.ridge)
        gain[(ns < self.leaf) | (n - ns < self.leaf)] = 0
        j, cut = np.unravel_index(gain.argmax(), gain.shape)
        return (int(j), int(cut)) if gain[j, cut] > 1e-6 else None

    def _walk(self, tree, b) -> np.ndarray:
        out = np.zeros(len(b))
        stack = [(0, np.arange(len(b)))]
        while stack:
            k, rows = stack.pop()
            if len(tree[k]) == 1:
                out[rows] = tree[k][0]
            else:
                j, cut, l, r = tree[k]
                left = b[rows, j] <= cut
                stack += [(l, rows[left]), (r, rows[~left])]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        b = self._binned(x)
        return 1 / (1 + np.exp(-self.start - sum(self._walk(t, b) for t in self.trees)))
