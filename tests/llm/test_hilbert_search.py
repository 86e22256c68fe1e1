import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm.hilbert_search import CurveRules, hilbert_keys, search


def test_hilbert_curve_is_a_path():
    for dims, bits in ((2, 4), (3, 3)):
        axes = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_keys(axes, bits)
        assert sorted(keys.tolist()) == list(range(1 << bits * dims))
        steps = np.abs(np.diff(axes[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 4
    x = (centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 16))).astype(np.float32)
    x[300:700] = x[300]
    return x


def test_recall_scores_and_ties(spark, vectors):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    odd = [(5000, None, 0), (5100, [0.0] * 16, 0), (5200, [float("nan")] * 16, 0), (5300, [None] * 16, 0), (5400, [1.0] * 3, 0), (None, [1.0] * 16, 0), (7, rows[7][1], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in search(frame, F.col("id") % 50 == 0, rules=CurveRules(curves=6, block=64, sample=64)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = vectors.astype(np.float64)
    assert sorted(got) == list(range(0, 1500, 50))
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.argsort(d, kind="stable")[:10].tolist()
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11)) and all(abs(d[v] - s) < 1e-12 for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        if 300 <= q < 700:
            assert [v for _, v, _ in found] == best
        hit += len({v for _, v, _ in found} & set(best))
    assert hit >= 0.9 * 10 * len(got)


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in search(frame, F.col("id") == 0).collect()]
    assert got == [(0, 1, 1, 2.236068)]
    assert search(frame.limit(0), F.col("id") == 0).count() == 0
