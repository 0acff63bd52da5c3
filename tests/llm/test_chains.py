from itertools import product

import numpy as np

from vigil.llm import chains


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    lens = np.array([1, 0, 2, 5, 6, 3])
    scores = rng.normal(size=(lens.sum(), 3))
    got, at = chains.viterbi(scores, lens, 0.7), 0
    for n in lens:
        s = scores[at:at + n]
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
        if n:
            assert abs(value(got[at:at + n]) - max(map(value, product(range(3), repeat=int(n))))) < 1e-9
        at += n


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(1)
    lens = np.array([3, 1, 0, 4, 2])
    odds, change, pairs = rng.normal(size=lens.sum()), rng.normal(size=(2, 2)), np.zeros((2, 2))
    got, want_pairs, at = chains.marginals(odds, lens, change, 0.3, pairs), np.zeros((2, 2)), 0
    for n in lens:
        paths = list(product((0, 1), repeat=int(n)))
        w = np.array([np.exp(sum(odds[at + i] * x for i, x in enumerate(p)) + (0.3 * p[0] if p else 0) + sum(change[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        w /= w.sum()
        for i in range(n):
            assert abs(got[at + i] - sum(x for x, p in zip(w, paths) if p[i])) < 1e-9
        for x, p in zip(w, paths):
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += x
        at += n
    assert np.allclose(pairs, want_pairs)


def test_long_chains_stay_in_range():
    odds = np.full(50000, 3.0)
    assert np.isfinite(chains.marginals(odds, np.array([50000]), np.array([[0, -5.0], [-5.0, 0]]), 0.0)).all()


def test_runs_end_with_their_sequence():
    first, n, per = chains.runs(np.array([1, 1, 0, 0, 0]), np.array([2, 0, 1, 2]))
    assert first.tolist() == [0, 2, 3] and n.tolist() == [2, 1, 2] and per.tolist() == [1, 0, 1, 1]
