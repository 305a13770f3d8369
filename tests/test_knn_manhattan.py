"""Manhattan neighbours: 16-bit numbers leave out pairs, exact distances decide."""

import numpy as np
import pytest

from docsignal.operators import knn


def plain(x, k):
    d = np.abs(x[:, None, :] - x[None, :, :]).sum(2)
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


@pytest.fixture
def small_halves(monkeypatch):
    monkeypatch.setattr(knn, "HALF_ROWS", 32)
    monkeypatch.setattr(knn, "TILE_ROWS", 48)


CLOUDS = {
    "even": lambda rng: rng.normal(size=(300, 16)),
    "far values": lambda rng: rng.standard_cauchy(size=(300, 5)),
    "copies": lambda rng: rng.integers(0, 3, (300, 4)).astype(float),
    "one value": lambda rng: np.full((300, 3), 7.5),
    "tiny": lambda rng: rng.normal(size=(300, 6)) * 1e-300,
    "one wide column": lambda rng: rng.normal(size=(300, 6)) * np.array([1e9, 1, 1, 1, 1, 1]),
    "many columns": lambda rng: rng.normal(size=(200, 700)),
}


@pytest.mark.parametrize("cloud", sorted(CLOUDS))
@pytest.mark.parametrize("k", [1, 4])
def test_rows_of_a_block_find_their_nearest(small_halves, cloud, k):
    x = CLOUDS[cloud](np.random.default_rng(5))
    np.testing.assert_allclose(knn.nearest_inside(x, k, 1.0), plain(x, k), rtol=1e-9)


def test_other_exponents(small_halves):
    x = np.random.default_rng(6).normal(size=(300, 4))
    np.testing.assert_allclose(knn.nearest_inside(x, 3, 3.0), knn.nearest(x, x, 3, 3.0, True), rtol=1e-9)


def test_few_pairs_of_two_blocks_need_an_exact_distance(monkeypatch):
    """Before, ``pairwise`` computed all of them."""
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(2, 500, 16))
    reach = [knn.nearest(x, x, 3, 1.0, True)[:, -1] for x in (a, b)]
    both = np.abs(a[:, None, :] - b[None, :, :]).sum(2)
    monkeypatch.setattr(knn, "pairwise", lambda *_: pytest.fail("all pairs were computed"))
    for found, d, own in zip(knn.nearer_pairs(a, b, *reach, 3, 1.0), (both, both.T), reach):
        expected = [sorted(row[row < far])[:3] for row, far in zip(d, own)]
        assert found[0].tolist() == [i for i, row in enumerate(expected) for _ in row]
        np.testing.assert_allclose(found[1], [v for row in expected for v in row], rtol=1e-12)
