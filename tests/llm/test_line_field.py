"""The line classifier's forward-backward marginals against all label sequences."""

import itertools

import numpy as np
import pytest

from tripledger.llm.op5_quality_classifier import _sigmoid, _through, fit, passes


def _score(unary, pairs, labels):
    """Log weight of one label sequence: good lines give their score, every pair its own."""
    total = sum(u for u, y in zip(unary, labels) if y)
    return total + sum(pairs[a, b] for a, b in zip(labels, labels[1:]))


def _marginals(unary, pairs):
    sequences = list(itertools.product((0, 1), repeat=len(unary)))
    weights = np.exp([_score(unary, pairs, y) for y in sequences])
    return weights @ np.array(sequences) / weights.sum()


@pytest.mark.parametrize("seed", range(6))
def test_marginals_equal_enumeration_of_all_label_sequences(seed):
    rng = np.random.default_rng(seed)
    sizes = [3, 0, 1, 7, 2, 7, 0]  # documents of unequal lengths, some without lines
    first = np.concatenate(([0], np.cumsum(sizes)))
    unary = rng.normal(0, 2, first[-1])
    pairs = rng.normal(0, 2, (2, 2))  # not symmetric: direction matters
    ahead, behind = passes(unary, first, pairs)
    got = _sigmoid(ahead + behind)
    for a, b in zip(first, first[1:]):
        if b > a:
            assert np.allclose(got[a:b], _marginals(unary[a:b], pairs), atol=1e-9)


def test_extreme_scores_stay_finite():
    unary = np.array([800.0, -800.0, 0.0, 800.0])
    pairs = np.array([[300.0, -300.0], [-300.0, 300.0]])
    ahead, behind = passes(unary, np.array([0, 4]), pairs)
    assert np.isfinite(ahead).all() and np.isfinite(behind).all()
    assert np.isfinite(_through(unary, pairs)).all()


def test_no_documents_and_documents_without_lines():
    for first in ([0], [0, 0, 0]):
        ahead, behind = passes(np.zeros(0), np.array(first), np.zeros((2, 2)))
        assert len(ahead) == len(behind) == 0


def _likelihood(field, features, first, label):
    """Log-likelihood of the documents' labels, by enumeration."""
    total = 0.0
    for d, (a, b) in enumerate(zip(first, first[1:])):
        unary = features[a:b] @ field.weights
        scores = [_score(unary, field.pairs, y) for y in itertools.product((0, 1), repeat=b - a)]
        total += _score(unary, field.pairs, (int(label[d]),) * (b - a)) - np.logaddexp.reduce(scores)
    return total


def test_the_fit_stands_at_a_maximum_of_the_penalised_likelihood():
    """Moving any pair score, or the first weights, either way does not raise it."""
    from tripledger.llm import op5_quality_classifier as op5

    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 6, 40)
    first = np.concatenate(([0], np.cumsum(sizes)))
    label = rng.integers(0, 2, 40)
    own = rng.normal(0, 1, (first[-1], op5.OWN))
    own[:, 0] = 1
    own[:, 1] += np.repeat(label, sizes)
    field = fit(own, np.ones(first[-1]), first, label.astype(float), steps=2000)
    features = op5.with_neighbours(own, first)
    n = first[-1]

    def objective(weights, pairs):
        moved = op5.Field(weights, pairs, 1.0, 0.0)
        theta = np.concatenate([weights, pairs.ravel()])
        return _likelihood(moved, features, first, label) / n - 0.5e-3 * (theta ** 2).sum()

    slopes = []
    step = 1e-4
    for i in range(5):
        move = np.zeros_like(field.weights)
        move[i] = step
        slopes.append((objective(field.weights + move, field.pairs)
                       - objective(field.weights - move, field.pairs)) / (2 * step))
    for i, j in itertools.product((0, 1), repeat=2):
        move = np.zeros((2, 2))
        move[i, j] = step
        slopes.append((objective(field.weights, field.pairs + move)
                       - objective(field.weights, field.pairs - move)) / (2 * step))
    assert np.abs(slopes).max() < 5e-3, slopes
