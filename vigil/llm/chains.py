"""Dynamic programs over many sequences at once: sequences of like length step together as columns of one array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vigil.llm.common import offsets


def groups(lens: np.ndarray):
    """Yields (members, at, inside) for sequences laid end to end: ``at`` (steps x members) are flat positions, and
    ``inside`` says which of them exist. A group's lengths lie within a factor of two, so padding at most doubles the work."""
    start = offsets(lens)[:-1]
    size = np.ceil(np.log2(np.maximum(lens, 1))).astype(int)
    for k in np.unique(size[lens > 0]):
        members = np.flatnonzero((size == k) & (lens > 0))
        steps = np.arange(lens[members].max())[:, None]
        inside = steps < lens[members]
        yield members, start[members] + np.minimum(steps, lens[members] - 1), inside


def viterbi(scores: np.ndarray, lens: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of each position, for scores (positions x states) and a penalty for each change of state."""
    kind = np.int16 if scores.shape[1] < 1 << 15 else np.int32
    out = np.zeros(len(scores), kind)
    for _, at, inside in groups(lens):
        s = scores[at] * inside[:, :, None]  # steps beyond the end change no maximum
        steps, m = at.shape
        best, stay, back = np.zeros((m, scores.shape[1]), s.dtype), np.ones(s.shape, bool), np.zeros((steps, m), kind)
        for t in range(steps):
            if t:
                top = best.max(1, keepdims=True) - penalty
                back[t] = best.argmax(1)
                stay[t] = best >= top
                np.maximum(best, top, out=best)
            best = best + s[t]
        state, col, path = best.argmax(1), np.arange(m), np.zeros((steps, m), kind)
        for t in range(steps - 1, -1, -1):
            path[t] = state
            state = np.where(stay[t, col, state], state, back[t])
        out[at[inside]] = path[inside]
    return out


def marginals(odds: np.ndarray, lens: np.ndarray, change: np.ndarray, start: float, pairs: np.ndarray | None = None) -> np.ndarray:
    """Probability of state 1 at each position of two-state chains, by forward and backward sums. The expected number
    of steps from state i to state j is added to ``pairs[i, j]``, if given.

    ``odds``: log score of state 1 against state 0; ``change``: 2 x 2 log scores of the steps; ``start``: of state 1 at first.
    Sums are scaled at each step, so chains of any length stay in range.
    """
    out, step = np.zeros(len(odds)), np.exp(change)
    for _, at, inside in groups(lens):
        e = np.where(inside, np.exp(np.clip(odds[at], -30, 30)), 1.0)
        steps, m = at.shape
        fwd = np.zeros((steps, m))  # probability of state 1 from what stands before and here
        one = np.exp(start) * e[0] / (1 + np.exp(start) * e[0])
        fwd[0] = one
        for t in range(1, steps):
            a = (one * step[1, 1] + (1 - one) * step[0, 1]) * e[t]
            b = one * step[1, 0] + (1 - one) * step[0, 0]
            one = a / (a + b)
            fwd[t] = one
        b1 = b0 = np.full(m, 0.5)
        for t in range(steps - 1, -1, -1):
            if pairs is not None and t:
                a1 = fwd[t - 1]
                x = np.array([[(1 - a1) * step[0, 0] * b0, (1 - a1) * step[0, 1] * e[t] * b1], [a1 * step[1, 0] * b0, a1 * step[1, 1] * e[t] * b1]])
                pairs += (x / x.sum(axis=(0, 1)))[:, :, inside[t]].sum(axis=2)
            p1, p0 = fwd[t] * b1, (1 - fwd[t]) * b0
            fwd[t] = p1 / (p1 + p0)
            here = inside[t]
            n1, n0 = step[1, 1] * e[t] * b1 + step[1, 0] * b0, step[0, 1] * e[t] * b1 + step[0, 0] * b0
            total = n1 + n0
            b1, b0 = np.where(here, n1 / total, b1), np.where(here, n0 / total, b0)
        out[at[inside]] = fwd[inside]
    return out


def runs(labels: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First positions and lengths of the runs of equal labels, which end where a sequence ends, and runs per sequence."""
    owner = np.repeat(np.arange(len(lens)), lens)
    if not len(owner):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(len(lens), int)
    first = np.flatnonzero(np.concatenate([[True], (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])]))
    return first, np.diff(np.append(first, len(owner))), np.bincount(owner[first], minlength=len(lens))


def list_of_structs(counts: np.ndarray, fields: dict[str, pa.Array]) -> pa.Array:
    """An Arrow list column with ``counts`` structs in each row, their fields laid end to end."""
    return pa.ListArray.from_arrays(pa.array(offsets(counts), pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
