"""Positive-unlabelled learning with the non-negative unbiased risk, in numpy."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Scorer:
    """A standardised network with one hidden layer (or none) and the line that turns its output into a score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        h = self.inputs(x)
        if len(self.weights) == 4:
            h = np.maximum(h @ self.weights[0] + self.weights[1], 0)
        return h @ self.weights[-2] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.raw(x) + self.shift)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 0, epochs: int = 40, batch: int = 512, rate: float = 0.01, decay: float = 1e-4, slack: float = 0.0, seed: int = 5, mean: np.ndarray | None = None, scale: np.ndarray | None = None) -> Scorer:
    """Minimise pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)]) for the sigmoid loss l, with Adam.

    Where a batch makes the second term less than -slack, its gradient is followed the
    other way, so that the risk of the unseen negatives can't be fitted below zero. Inputs
    are standardised by mean and scale, if given, else by those of both samples.
    """
    rng = np.random.default_rng(seed)
    everything = np.concatenate([positive, unlabelled])
    middle, spread = (everything.mean(axis=0) if mean is None else mean), (everything.std(axis=0) if scale is None else scale)
    model = Scorer(np.asarray(middle, np.float32), np.asarray(spread, np.float32) + np.float32(1e-6))
    del everything
    p, u = model.inputs(positive).astype(np.float32, copy=False), model.inputs(unlabelled).astype(np.float32, copy=False)
    width = p.shape[1]
    if hidden:
        model.weights = [rng.normal(0, 1 / math.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden), np.zeros(1)]
    else:
        model.weights = [np.zeros(width), np.zeros(1)]
    model.weights = [w.astype(np.float32) for w in model.weights]
    first, second = [np.zeros_like(w) for w in model.weights], [np.zeros_like(w) for w in model.weights]
    steps, turn = max(1, -(-len(u) // batch)), 0
    per_step = max(1, min(len(p), batch))
    for _ in range(epochs):
        order = rng.permutation(len(u))
        for s in range(steps):
            bu = u[order[s * batch : (s + 1) * batch]]
            bp = p[rng.integers(0, len(p), per_step)]
            x = np.concatenate([bp, bu])
            hid = np.maximum(x @ model.weights[0] + model.weights[1], 0) if hidden else x
            out = hid @ model.weights[-2] + model.weights[-1]
            q = sigmoid(out)
            slope = (q * (1 - q)).astype(np.float32)  # of the loss l(-f) = q; that of l(f) = 1 - q is its negative
            n_p = len(bp)
            negatives = q[n_p:].mean() - prior * q[:n_p].mean()
            grad = np.zeros(len(x), np.float32)
            if negatives >= -slack:
                grad[:n_p] = -2 * prior * slope[:n_p] / n_p
                grad[n_p:] = slope[n_p:] / len(bu)
            else:
                grad[:n_p] = prior * slope[:n_p] / n_p
                grad[n_p:] = -slope[n_p:] / len(bu)
            grads = [hid.T @ grad + decay * model.weights[-2], np.array([grad.sum()], np.float32)]
            if hidden:
                back = np.outer(grad, model.weights[-2]) * (hid > 0)
                grads = [x.T @ back + decay * model.weights[0], back.sum(axis=0), *grads]
            turn += 1
            for w, g, a, b in zip(model.weights, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.999**turn)) + 1e-8)
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, gamma: float = 0.01, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled, from outputs of a model on rows it was not trained on.

    Best bin estimation: of all rows that reach an output, the unlabelled ones' share over
    the positives' is the prior where only positives get there, and more elsewhere. It is
    taken where that ratio and its confidence bound together are least.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.sort(positive)[::-1]
    reach_p = np.arange(1, len(cuts) + 1) / len(cuts)
    reach_u = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    last = np.concatenate([cuts[1:] != cuts[:-1], [True]])  # of equal outputs
    reach_p, reach_u = reach_p[last], reach_u[last]
    slack = sum(math.sqrt(math.log(4 / delta) / (2 * len(x))) for x in (positive, unlabelled))
    best = int(np.argmin(reach_u / reach_p + (1 + gamma) * slack / reach_p))
    return float(min(0.98, max(0.005, reach_u[best] / reach_p[best])))


def scored(model: Scorer, unlabelled: np.ndarray, threshold: float) -> Scorer:
    """Let the model's own decision, an output over 0, be a score over the threshold; no label is used."""
    out = model.raw(unlabelled)
    model.slope = float(4 / (out.std() + 1e-6)) if len(out) else 1.0
    model.shift = math.log(threshold / (1 - threshold))
    return model


def halves(n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    order = np.random.default_rng(seed).permutation(n)
    return order[: (n + 1) // 2], order[(n + 1) // 2 :]
