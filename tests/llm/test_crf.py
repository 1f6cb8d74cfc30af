import itertools

import numpy as np
import pytest

from tiermill.llm.crf import Chain, fit, marginals, viterbi


def brute(scores, counts, chain):
    n, k = scores.shape
    gamma, pairs, best, o = np.zeros((n, k)), np.zeros((k, k)), np.zeros(n, dtype=int), 0
    for c in counts:
        top, total = None, 0.0
        for p in itertools.product(range(k), repeat=int(c)) if c else ():
            s = chain.start[p[0]] + sum(scores[o + i, p[i]] for i in range(c)) + sum(chain.trans[p[i], p[i + 1]] for i in range(c - 1))
            total += np.exp(s)
            top = max(top, (s, [-x for x in p])) if top else (s, [-x for x in p])
        for p in itertools.product(range(k), repeat=int(c)) if c else ():
            w = np.exp(chain.start[p[0]] + sum(scores[o + i, p[i]] for i in range(c)) + sum(chain.trans[p[i], p[i + 1]] for i in range(c - 1))) / total
            for i in range(c):
                gamma[o + i, p[i]] += w
            for i in range(c - 1):
                pairs[p[i], p[i + 1]] += w
        if c:
            best[o:o + c] = [-x for x in top[1]]
        o += c
    return gamma, pairs, best


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_decoders_equal_brute_force(block):
    rng = np.random.default_rng(block)
    counts = np.array([3, 0, 5, 1, 6])
    scores, chain = rng.normal(size=(15, 3)), Chain(rng.normal(size=(3, 3)), rng.normal(size=3))
    gamma, pairs, best = brute(scores, counts, chain)
    got, joint = marginals(scores, counts, chain, block=block, pairs=True)
    assert np.allclose(got, gamma) and np.allclose(joint, pairs)
    assert (viterbi(scores, counts, chain) == best).all()


def test_nothing():
    chain = Chain(np.zeros((2, 2)), np.zeros(2))
    assert marginals(np.zeros((0, 2)), np.zeros(0, dtype=int), chain)[0].shape == (0, 2)
    assert len(viterbi(np.zeros((0, 2)), np.zeros(3, dtype=int), chain)) == 0


def test_fit_learns_features_and_transitions():
    rng = np.random.default_rng(1)
    labels, items, counts = [], [], []
    for _ in range(200):
        y = int(rng.integers(2))
        counts.append(20)
        for _ in range(20):
            y = y if rng.random() < 0.9 else 1 - y
            labels.append(y)
            items.append(y if rng.random() < 0.7 else int(rng.integers(2)))
    items, labels, counts = map(np.array, (items, labels, counts))
    weights, chain = fit(items, np.array([[1], [2]]), labels, counts, 3, 2)
    assert chain.trans[0, 0] > chain.trans[0, 1] and chain.trans[1, 1] > chain.trans[1, 0]
    got = viterbi(weights[np.array([[1], [2]])].sum(axis=1)[items], counts, chain)
    assert (got == labels).mean() > (items == labels).mean() + 0.02  # the chain adds to what a place shows by itself
