"""The block-max index against a scan of all examples."""

import numpy as np
import pytest

from lauter.llm.toxicity import BlockMaxIndex


def vectors(rng, n, n_terms, most):
    out = []
    for _ in range(n):
        terms = np.sort(rng.choice(n_terms, rng.integers(1, most + 1), replace=False))
        weights = rng.choice([0.5, 1.0, 2.0], len(terms))  # many ties
        out.append((terms, weights / np.linalg.norm(weights)))
    return out


def scan(examples, terms, weights, k):
    query = dict(zip(terms.tolist(), weights.tolist(), strict=True))
    found = []
    for i, (own, values) in enumerate(examples):
        cosine = sum(query.get(t, 0.0) * v for t, v in zip(own.tolist(), values.tolist(), strict=True))
        if cosine > 0:
            found.append((cosine, i))
    return sorted(found, key=lambda f: (-round(f[0], 12), f[1]))[:k]


@pytest.mark.parametrize(("n", "n_terms", "most", "block"), [(1, 3, 2, 4), (300, 12, 5, 8), (700, 60, 20, 16), (900, 500, 40, 128)])
def test_nearest_is_that_of_a_scan(n, n_terms, most, block):
    rng = np.random.default_rng(n)
    examples = vectors(rng, n, n_terms, most)
    index = BlockMaxIndex(examples, n_terms, block)
    for terms, weights in [*vectors(rng, 60, n_terms, most), (np.zeros(0, np.int64), np.zeros(0))]:
        for k in (1, 15):
            expected, got = scan(examples, terms, weights, k), index.nearest(terms, weights, k)
            assert [i for _, i in got] == [i for _, i in expected]
            assert np.allclose([s for s, _ in got], [s for s, _ in expected], atol=1e-12)


def test_blocks_out_of_reach_are_not_visited():
    """One example equals the query; blocks without its terms have no bound to speak of."""
    examples = [(np.array([i % 50]), np.array([1.0])) for i in range(1_000)]
    examples.sort(key=lambda e: e[0][0])
    index = BlockMaxIndex(examples, 50, 20)
    visited = []
    plain = index._scores
    index._scores = lambda blocks, *rest: visited.append(len(blocks)) or plain(blocks, *rest)
    assert [i for _, i in index.nearest(np.array([7]), np.array([1.0]), 5)] == [140, 141, 142, 143, 144]
    assert sum(visited) == 1


def test_an_index_of_nothing():
    assert BlockMaxIndex([], 4).nearest(np.array([1]), np.array([1.0]), 3) == []
