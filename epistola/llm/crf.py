"""Linear-chain conditional random fields over many sequences at once, by numpy.

Sequences lie one behind the other in one array. They are ordered by length, and a step advances all that are still running, so whole
sequences of any length are handled exactly, and a long one costs its own steps only.
"""

from __future__ import annotations

import numpy as np


def forward_backward(scores: np.ndarray, offsets: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Posterior marginals (n, labels) of the states; with pairs also the expected transition counts and first-state marginals."""
    n, k = scores.shape
    lens = np.diff(offsets)
    order = np.argsort(-lens, kind="stable")
    lens, at = lens[order], offsets[:-1][order]
    live = int((lens > 0).sum())
    lens, at = lens[:live], at[:live]
    gamma = np.zeros((n, k))
    if not live:
        return (gamma, np.zeros((k, k)), np.zeros(k)) if pairs else gamma
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    t = np.exp(trans - trans.max())
    first = np.exp(start - start.max())
    longest = int(lens[0])
    running = live - np.searchsorted(lens[::-1], np.arange(longest + 1), "right")  # sequences longer than i
    alpha = np.empty((n, k))
    a = e[at] * first
    a /= a.sum(axis=1, keepdims=True)
    alpha[at] = a
    for i in range(1, longest):
        r = running[i]
        where = at[:r] + i
        a = (a[:r] @ t) * e[where]
        a /= a.sum(axis=1, keepdims=True)
        alpha[where] = a
    right = np.empty((n, k))  # of each state: its emission times what follows
    back = np.ones((live, k))
    tt = np.ascontiguousarray(t.T)
    for i in range(longest - 1, -1, -1):
        r = running[i]
        where = at[:r] + i
        b = back[:r]
        g = alpha[where] * b
        gamma[where] = g / g.sum(axis=1, keepdims=True)
        x = b * e[where]
        x /= x.sum(axis=1, keepdims=True)
        right[where] = x
        back[:r] = x @ tt
    if not pairs:
        return gamma
    inner = np.ones(n, bool)
    inner[offsets[:-1][np.diff(offsets) > 0]] = False
    nxt = np.flatnonzero(inner)
    lhs, rhs = alpha[nxt - 1], right[nxt]
    z = ((lhs @ t) * rhs).sum(axis=1, keepdims=True)
    return gamma, (lhs / z).T @ rhs * t, gamma[at].sum(axis=0)


def fit(emit, grad_emit, params: np.ndarray, labels: np.ndarray, offsets: np.ndarray, weights: np.ndarray, k: int, rounds: int, rate: float, ridge: float):
    """Maximises the weighted conditional likelihood by AdaGrad over all sequences.

    emit(params) gives the scores (n, k); grad_emit(residual) the gradient for params. weights: of each state.
    """
    trans, start = np.zeros((k, k)), np.zeros(k)
    sums = [np.full_like(params, 1e-6), np.full_like(trans, 1e-6), np.full_like(start, 1e-6)]
    truth = np.zeros((len(labels), k))
    truth[np.arange(len(labels)), labels] = 1
    firsts = offsets[:-1][np.diff(offsets) > 0]
    inner = np.ones(len(labels), bool)
    inner[firsts] = False
    nxt = np.flatnonzero(inner)
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[nxt - 1], labels[nxt]), 1)
    total = max(1.0, weights.sum())
    for _ in range(rounds):
        gamma, expected, first = forward_backward(emit(params), offsets, trans, start, pairs=True)
        grads = [
            grad_emit((truth - gamma) * weights[:, None]) / total - ridge * params,
            (seen - expected) / max(1, len(nxt)) - ridge * trans,
            (truth[firsts].sum(axis=0) - first) / max(1, len(firsts)) - ridge * start,
        ]
        for p, g, s in zip((params, trans, start), grads, sums, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s)
    return params, trans, start
