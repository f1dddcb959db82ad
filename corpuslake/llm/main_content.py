"""The main body of a page: a linear-chain CRF over its lines.

The tables hold no markup, so the blocks are the text's lines; a feature is a
hashed word or pair of words, a shape, a neighbour's shape or a place. The
field is trained on labelled pages and decoded by Viterbi. Labelled pages are
given, or a bounded sample is labelled by trusted wordings and by what repeats
from page to page; neither is a feature.
"""

from __future__ import annotations

import numpy as np

from .page_lines import FEATURES, Lines, page_labels, repeated_lines

#: States: main content, furniture, box of links. Training pages at most, and
#: at most so many characters of each (longer ones train no model but are
#: scored whole like all others).
STATES, MOST_PAGES, LONGEST = 3, 1_500, 20_000

Model = tuple[np.ndarray, np.ndarray]


def _emissions(d: Lines, weights: np.ndarray) -> np.ndarray:
    """Score of each state of each line; that of main content is 0, the others
    are told against it."""
    e = np.zeros((d.count, STATES))
    for s in range(1, STATES):
        e[:, s] = np.bincount(d.line, weights[d.ids, s] * d.value, d.count)
    return e


def _blank(line: str) -> bool:
    return not line.replace("\xa0", " ").strip()


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _gradient(d: Lines, y: np.ndarray, w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the conditional log-likelihood: (of emissions, of moves).
    Forward and backward sums, all pages of the batch stepping together."""
    e = _emissions(d, w)
    fwd, bwd = e.copy(), np.zeros_like(e)
    longest = int(d.sizes.max())
    for k in range(1, longest):
        i = d.start[d.live(k)] + k
        fwd[i] += _logsum(fwd[i - 1][:, :, None] + t[None], 1)
    for k in range(longest - 2, -1, -1):
        i = d.start[d.live(k + 1)] + k
        bwd[i] = _logsum(t[None] + (e[i + 1] + bwd[i + 1])[:, None, :], 2)
    z = np.repeat(_logsum(fwd[d.start + d.sizes - 1], 1), d.sizes)
    gap = -np.exp(fwd + bwd - z[:, None])
    gap[np.arange(d.count), y] += 1
    inner = np.ones(d.count, bool)
    inner[d.start] = False
    i = np.flatnonzero(inner)
    both = np.exp(fwd[i - 1][:, :, None] + t[None] + (e[i] + bwd[i])[:, None, :] - z[i][:, None, None])
    moves = -both.sum(axis=0)
    np.add.at(moves, (y[i - 1], y[i]), 1)
    return gap, moves


def train(pages: list[list[str]], labels: list[list[int]], epochs: int = 14, batch: int = 60, rate: float = 0.1, decay: float = 1e-5) -> Model:
    """Weights (features x states) and moves by Adam on the conditional
    likelihood. labels: a state for each line, -1 for blank. The same on every
    run."""
    data = [(p, [max(0, x) for line, x in zip(p, lab) if not _blank(line)]) for p, lab in zip(pages, labels)]
    data = [x for x in data if x[1]]
    w, t = np.zeros((FEATURES, STATES)), np.zeros((STATES, STATES))
    if not data:
        return w, t
    mix = np.random.default_rng(5).permutation(len(data))
    parts = [[data[i] for i in mix[a : a + batch]] for a in range(0, len(data), batch)]
    parts = [(Lines([p for p, _ in part]).features_only(), np.array([s for _, y in part for s in y])) for part in parts]
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    step, steps = 0, epochs * len(parts)
    for _ in range(epochs):
        for d, y in parts:
            step += 1
            gap, moves = _gradient(d, y, w, t)
            g = np.zeros_like(w)
            for s in range(1, STATES):
                g[:, s] = np.bincount(d.ids, gap[d.line, s] * d.value, FEATURES)
            scale = 1 / len(d.sizes)
            lr = rate * (1 - step / (steps + 1))
            for x, m, v, gx in ((w, mw, vw, g * scale - decay * w), (t, mt, vt, moves * scale)):
                m *= 0.9
                m += 0.1 * gx
                v *= 0.99
                v += 0.01 * gx * gx
                x += lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return w.astype(np.float32), t


def viterbi(d: Lines, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best state of each line; all pages of the batch step together."""
    if not d.count:
        return np.zeros(0, np.int64)
    e, start = _emissions(d, weights), d.start
    best = e[start].copy()
    back = np.zeros((d.count, STATES), np.int8)
    longest = int(d.sizes.max())
    for k in range(1, longest):
        live = d.live(k)
        reach = best[live][:, :, None] + moves[None]
        back[start[live] + k] = reach.argmax(axis=1)
        best[live] = reach.max(axis=1) + e[start[live] + k]
    state = best.argmax(axis=1)
    out = np.zeros(d.count, np.int64)
    for k in range(longest - 1, -1, -1):
        live = d.live(k)
        out[start[live] + k] = state[live]
        if k:
            state[live] = back[start[live] + k, state[live]]
    return out


def fit_pages(pages: list[list[str]], labels: list[list[int]] | None = None) -> Model:
    """A model from training pages. labels: a state for each line (labelled by
    hand); without, the trusted wordings and what repeats over these pages."""
    if labels is None:
        repeated = repeated_lines(pages)
        labels = [page_labels(p, repeated) for p in pages]
    return train(pages, labels)
