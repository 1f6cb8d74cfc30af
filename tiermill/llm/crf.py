"""Linear-chain conditional random field over many sequences at once.

Sequences lie one after another in flat arrays, with their lengths in
``counts``.  Every step handles one place of all sequences; ``marginals`` first
cuts long sequences into blocks, whose transfer matrices are multiplied and
chained, so one long document does not hold up the others.  Both decoders are
exact for whole sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Learned scores: ``trans[a, b]`` for label b after a, ``start`` for the first."""

    trans: np.ndarray
    start: np.ndarray


def _blocks(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First place, length, number within its sequence and sequence of each block."""
    many = -(-counts // block)
    seq = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(len(seq)) - np.repeat(np.cumsum(many) - many, many)
    first = np.repeat(np.cumsum(counts) - counts, many) + nth * block
    return first, np.minimum(block, counts[seq] - nth * block), nth, seq


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, counts: np.ndarray, chain: Chain, block: int = 256,
              pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward.  Probability of each label at each place and, if asked
    for, the expected number of each pair of neighbouring labels."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k)), np.zeros((k, k)) if pairs else None
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(chain.trans - chain.trans.max())
    begin = np.exp(chain.start - chain.start.max())
    first, length, nth, seq = _blocks(counts, block)
    order = np.argsort(-length, kind="stable")
    first, length, nth, seq = first[order], length[order], nth[order], seq[order]
    alive = np.searchsorted(-length, -np.arange(length[0]), "left")  # blocks longer than t
    into = np.where((nth == 0)[:, None, None], begin[None, None, :], a[None])

    ahead, behind = np.full((len(first), k), 1.0 / k), np.ones((len(first), k))
    if nth.max() > 0:
        long = np.flatnonzero(np.isin(seq, seq[nth > 0]))
        m = into[long] * e[first[long]][:, None, :]
        for t in range(1, int(length[long[0]])):
            on = int(np.searchsorted(-length[long], -t, "left"))
            m[:on] = (m[:on].reshape(-1, k) @ a).reshape(-1, k, k) * e[first[long[:on]] + t][:, None, :]
            if t % 8 == 0:
                m[:on] /= m[:on].max(axis=(1, 2), keepdims=True)
        m /= m.max(axis=(1, 2), keepdims=True)
        row = {}
        by_nth = np.argsort(nth[long], kind="stable")
        edges = np.searchsorted(nth[long][by_nth], np.arange(nth.max() + 2))
        levels = [by_nth[edges[i]:edges[i + 1]] for i in range(nth.max() + 1)]
        place = np.full(len(counts), -1)
        for i, own in enumerate(levels):
            if i:
                prev = place[seq[long[own]]]
                ahead[long[own]] = _unit(np.einsum("bi,bij->bj", ahead[long[prev]], m[prev]))
            place[seq[long[own]]] = own
            row[i] = own
        after = np.full(len(counts), -1)
        for i in range(len(levels) - 1, -1, -1):
            own = row[i]
            nxt = after[seq[long[own]]]
            has = nxt >= 0
            behind[long[own[has]]] = _unit(np.einsum("bij,bj->bi", m[nxt[has]], behind[long[nxt[has]]]))
            after[seq[long[own]]] = own

    alpha, beta = np.empty((n, k)), np.empty((n, k))
    x = _unit(np.einsum("bi,bij->bj", ahead, into) * e[first])
    alpha[first] = x
    for t in range(1, int(length[0])):
        on = alive[t]
        x = _unit((x[:on] @ a) * e[first[:on] + t])
        alpha[first[:on] + t] = x
    y = np.array(behind)
    beta[first + length - 1] = y
    for t in range(int(length[0]) - 2, -1, -1):
        on = alive[t + 1]
        y[:on] = _unit((y[:on] * e[first[:on] + t + 1]) @ a.T)
        beta[first[:on] + t] = y[:on]
    gamma = _unit(alpha * beta)
    if not pairs:
        return gamma, None
    inner = np.ones(n, dtype=bool)
    inner[(np.cumsum(counts) - counts)[counts > 0]] = False
    at = np.flatnonzero(inner)
    joint = alpha[at - 1][:, :, None] * a[None] * (e[at] * beta[at])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return gamma, joint.sum(axis=0)


def viterbi(scores: np.ndarray, counts: np.ndarray, chain: Chain) -> np.ndarray:
    """The best label sequence of each chain; ties go to the smaller label."""
    n, k = scores.shape
    best = np.zeros(n, dtype=np.int64)
    if not n:
        return best
    own = np.flatnonzero(counts > 0)
    first, length = (np.cumsum(counts) - counts)[own], counts[own]
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    alive = np.searchsorted(-length, -np.arange(length[0] + 1), "left")
    back = np.zeros((n, k), dtype=np.int8)
    x = chain.start[None] + scores[first]
    ends = np.array(x)
    for t in range(1, int(length[0])):
        on = alive[t]
        step = x[:on, :, None] + chain.trans[None]
        at = first[:on] + t
        back[at] = step.argmax(axis=1)
        x = step.max(axis=1) + scores[at]
        x -= x.max(axis=1, keepdims=True)
        ends[:on] = x
    y = ends.argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        on = alive[t]
        at = first[:on] + t
        best[at] = y[:on]
        y[:on] = back[at, y[:on]]
    return best


@dataclass
class Ragged:
    """Feature numbers of many rows, one after the other."""

    flat: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, matrix: np.ndarray) -> Ragged:
        """The rows of a matrix; number 0 is padding."""
        held = matrix > 0
        return cls(matrix[held], held.sum(axis=1))

    def rows(self, own: np.ndarray) -> Ragged:
        counts = self.counts[own]
        start = (np.cumsum(self.counts) - self.counts)[own]
        at = np.repeat(start - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return Ragged(self.flat[at], counts)


def fit(items: np.ndarray, features: np.ndarray | Ragged, labels: np.ndarray, counts: np.ndarray, size: int, n_labels: int,
        rounds: int = 8, parts: int = 8, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, Chain]:
    """Maximum likelihood by AdaGrad over batches of whole sequences.

    Row ``items[i]`` of ``features`` holds the feature numbers (below ``size``;
    number 0 is padding) of place i, so places that look alike share a row.
    Returns feature weights (size, n_labels) and the chain."""
    features = features if isinstance(features, Ragged) else Ragged.of(features)
    w, g_w = np.zeros((size, n_labels)), np.full((size, n_labels), 1e-6)
    trans, g_t = np.zeros((n_labels, n_labels)), np.full((n_labels, n_labels), 1e-6)
    start, g_s = np.zeros(n_labels), np.full(n_labels, 1e-6)
    first = np.cumsum(counts) - counts
    seqs = np.flatnonzero(counts > 0)
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        rng.shuffle(seqs)
        for part in np.array_split(seqs, min(parts, max(1, len(seqs)))):
            if not len(part):
                continue
            own = np.sort(part)
            places = np.concatenate([np.arange(first[s], first[s] + counts[s]) for s in own])
            kinds, at = np.unique(items[places], return_inverse=True)
            rows = features.rows(kinds)
            of = np.repeat(np.arange(len(kinds)), rows.counts)
            scores = np.stack([np.bincount(of, weights=w[rows.flat, label], minlength=len(kinds)) for label in range(n_labels)], axis=1)
            gamma, joint = marginals(scores[at], counts[own], Chain(trans, start), pairs=True)
            y = labels[places]
            grad = -gamma
            grad[np.arange(len(y)), y] += 1.0
            heads = np.cumsum(counts[own]) - counts[own]
            inner = np.ones(len(y), dtype=bool)
            inner[heads] = False
            seen = np.zeros_like(trans)
            nxt = np.flatnonzero(inner)
            np.add.at(seen, (y[nxt - 1], y[nxt]), 1.0)
            scale = 1.0 / len(y)
            for label in range(n_labels):
                of_kind = np.bincount(at, weights=grad[:, label], minlength=len(kinds))
                d = np.bincount(rows.flat, weights=of_kind[of], minlength=size) * scale
                d -= decay * scale * w[:, label]
                g_w[:, label] += d * d
                w[:, label] += rate * d / np.sqrt(g_w[:, label])
            d = (seen - joint) * scale
            g_t += d * d
            trans += rate * d / np.sqrt(g_t)
            d = grad[heads].sum(axis=0) * scale
            g_s += d * d
            start += rate * d / np.sqrt(g_s)
            w[0] = 0.0
    return w, Chain(trans, start)
