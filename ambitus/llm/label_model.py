"""A generative model of votes: learns how accurate and how correlated heuristic functions are, without labels (numpy).

Each function votes +1 (same), -1 (different) or 0 (abstains) on a pair.  For each of the two classes the votes follow a tree of
dependencies between functions, learned from the data (the spanning tree of greatest mutual information); tree, tables and the
share of matches are fitted by expectation maximisation on the counts of the vote patterns.  There are at most 3**k patterns,
whatever the number of pairs.
"""

from __future__ import annotations

import numpy as np


class LabelModel:
    def __init__(self, functions: int, rounds: int = 60, smoothing: float = 0.5, lean: tuple[tuple[float, float, float], tuple[float, float, float]] = ((0.8, 0.1, 0.1), (0.1, 0.1, 0.8)), strength: float = 0.01):
        """lean: shares of the votes -1, 0 and 1 that a function is taken to cast beforehand, among non-matches and among matches;
        they weigh as much as ``strength`` of all pairs."""
        self.k, self.rounds, self.smoothing, self.lean, self.strength = functions, rounds, smoothing, lean, strength
        self.prior = 0.5
        self.trees: list[list[tuple[int, int]]] = [[], []]
        self.tables: list[list[np.ndarray]] = [[], []]

    def _fit_class(self, votes: np.ndarray, weight: np.ndarray, lean: np.ndarray) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
        """lean: votes that the class makes likely beforehand, as pseudo counts by value -1, 0, +1."""
        k = self.k
        onehot = np.zeros((len(votes), k, 3))
        np.put_along_axis(onehot, (votes + 1)[:, :, None], 1.0, axis=2)
        joint = np.einsum("n,nia,njb->ijab", weight, onehot, onehot)
        single = np.einsum("n,nia->ia", weight, onehot) + lean
        single = single / single.sum(axis=1, keepdims=True)
        total = max(weight.sum(), 1e-9)
        info = np.full((k, k), -1.0)
        for i in range(k):
            for j in range(i):
                p = (joint[i, j] + self.smoothing / 9) / (total + self.smoothing)
                q = p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)
                info[i, j] = info[j, i] = float((p * np.log(p / q)).sum())
        order, tree, seen = [0], [(0, -1)], {0}
        while len(order) < k:  # greatest spanning tree
            i, j = max(((i, j) for i in order for j in range(k) if j not in seen), key=lambda e: (info[e], -e[1]))
            tree.append((j, i))
            order.append(j)
            seen.add(j)
        tables = []
        for j, parent in tree:
            if parent < 0:
                tables.append(single[j])
            else:  # row: the parent's vote; shrunk to the function's own distribution where the parent's vote is rare
                t = joint[parent, j] + 3 * self.smoothing * single[j][None, :]
                tables.append(t / t.sum(axis=1, keepdims=True))
        return tree, tables

    def _log_likelihood(self, c: int, votes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(votes))
        for (j, parent), table in zip(self.trees[c], self.tables[c]):
            v = votes[:, j] + 1
            out += np.log(table[v] if parent < 0 else table[votes[:, parent] + 1, v])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        votes = np.asarray(votes, dtype=int).reshape(-1, self.k)
        a, b = (self._log_likelihood(c, votes) + np.log(p) for c, p in ((0, 1 - self.prior), (1, self.prior)))
        return 1 / (1 + np.exp(np.clip(a - b, -700, 700)))

    def fit(self, votes: np.ndarray, counts: np.ndarray) -> LabelModel:
        votes, counts = np.asarray(votes, dtype=int).reshape(-1, self.k), np.asarray(counts, dtype=float)
        if not len(votes):
            flat = np.full(3, 1 / 3)
            self.trees = [[(j, -1) for j in range(self.k)]] * 2
            self.tables = [[flat] * self.k] * 2
            return self
        # the start is what the shares beforehand say: this also keeps the classes from changing places
        said = np.log(np.array(self.lean[1])) - np.log(np.array(self.lean[0]))
        p = 1 / (1 + np.exp(-np.clip(said[votes + 1].sum(axis=1), -30, 30)))
        strength = max(1.0, self.strength * counts.sum())
        lean = [np.tile(strength * np.array(shares), (self.k, 1)) for shares in self.lean]
        for _ in range(self.rounds):
            w = [counts * (1 - p), counts * p]
            self.prior = float(np.clip(w[1].sum() / counts.sum(), 0.001, 0.999))
            for c in (0, 1):
                self.trees[c], self.tables[c] = self._fit_class(votes, w[c], lean[c])
            new = self.posterior(votes)
            if np.abs(new - p).max() < 1e-6:
                break
            p = new
        return self

    def accuracies(self) -> np.ndarray:
        """For each function, (share of +1 among matches, share of -1 among non-matches) by the tree's marginals."""
        out = np.zeros((self.k, 2))
        for c, at in ((1, 2), (0, 0)):
            marginal: dict[int, np.ndarray] = {}
            for (j, parent), table in zip(self.trees[c], self.tables[c]):
                marginal[j] = table if parent < 0 else marginal[parent] @ table
                out[j, 0 if c else 1] = marginal[j][at]
        return out
