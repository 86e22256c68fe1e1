import numpy as np
import pytest

from postlens.operators import point_blocks as B


def blocks_of(x):
    held, points = B.pack(x)
    return (np.frombuffer(b"".join(held)).reshape(len(held), -1),
            np.frombuffer(b"".join(points)).reshape(len(held), x.shape[1], -1))


def brute(x, c):
    d = ((x[:, None] - c) ** 2).sum(2)
    own = d.argmin(1)
    return np.bincount(own, minlength=len(c)), np.stack([x[own == j].sum(0) for j in range(len(c))]), d.min(1).sum()


@pytest.mark.parametrize("n, dims", [(1, 1), (9, 2), (5000, 3), (3000, 7), (700, 40)])
def test_blocks_equal_all_points_with_all_centres(n, dims):
    rng = np.random.default_rng(n)
    for x in (rng.normal(size=(n, dims)), rng.integers(0, 4, (n, dims)).astype(float), np.ones((n, dims)), rng.normal(size=(n, dims)) * 1e6 + 1e7):
        held, points = blocks_of(x)
        assert held[:, 0].sum() == n
        for k in (1, 4):
            # centres among the points: ties and points that are centres, two of them equal
            c = x[rng.integers(0, n, k)]
            got, want = B.add_up(held, points, c), brute(x, c)
            assert got[0].tolist() == want[0].tolist()
            assert np.allclose(got[1], want[1]) and np.isclose(got[2], want[2])


def test_few_points_are_compared():
    x = np.random.default_rng(1).normal(size=(400_000, 3))
    held, _ = blocks_of(x)
    c = x[:4]
    may = B.left_over(held[:, 5:8], held[:, 8:11], c)
    left = may.sum(1)
    assert (held[left > 1, 0] * left[left > 1]).sum() < 0.25 * len(x) * len(c)
