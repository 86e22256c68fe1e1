import pytest

from postlens.errors import ClusteringInputError, ElbowUndefined
from postlens.operators import cluster as C


def test_standardize_population_and_constant(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, 3.0, 7.0)], "id long, a double, b double")
    out = {r["id"]: r for r in C.standardize(df, ["a", "b"], keep=["id"]).collect()}
    assert out[1]["a"] == -1.0 and out[2]["a"] == 1.0
    assert out[1]["b"] == 0.0


def test_standardize_rejects_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "id long, a double")
    with pytest.raises(ClusteringInputError):
        C.standardize(df, ["a"])


def test_elbow_known_curve(spark):
    sse = [100, 30, 12, 9, 8, 7.5, 7, 6.8, 6.6, 6.5]
    curve = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(sse)], "k int, sse double")
    assert C.elbow(curve) == 3


def test_elbow_undefined_on_line(spark):
    curve = spark.createDataFrame([(k, float(100 - 10 * k)) for k in range(1, 11)], "k int, sse double")
    with pytest.raises(ElbowUndefined):
        C.elbow(curve)


def test_assign_ties_lowest_id(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 2.0), (3, 1.0)], "id long, x double")
    out = {r["id"]: r["c"] for r in C.assign_clusters(df, ["x"], [[0.0], [2.0]], "c").collect()}
    assert out == {1: 0, 2: 1, 3: 0}


def test_kmeans_and_sse_curve(spark):
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(
        [(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (11, 10), (20, 0), (21, 0), (20, 1)])]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    lab = C.kmeans(df, ["x", "y"], k=3, n_init=3, max_iter=20, seed=1)
    groups = {}
    for r in lab.collect():
        groups.setdefault(r["kmlabel"], set()).add(r["id"] // 3)
    assert sorted(len(g) for g in groups.values()) == [1, 1, 1]
    curve = C.sse_curve(df, ["x", "y"], max_cluster=4, n_init=2, max_iter=20, seed=1)
    s = [r["sse"] for r in curve.orderBy("k").collect()]
    assert all(a >= b - 1e-9 for a, b in zip(s, s[1:]))
    with pytest.raises(ClusteringInputError):
        C.kmeans(df.limit(2), ["x", "y"], k=3)


def test_km_full_flow(spark):
    pts = [(i, float(i % 3) * 10 + (i % 2) * 0.1, float(i % 3)) for i in range(30)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    out = C.km(df, ["x", "y"], n_cluster=3, n_init=2, max_iter=20, seed=5)
    assert set(out.columns) == {"id", "x", "y", "kmlabel"} and out.count() == 30


def test_kmeans_equals_brute_force_on_any_partitions(spark):
    import hashlib

    import numpy as np

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.4, (40, 2)) for c in ((0, 0), (3, 0), (0, 3))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double")
    best = None
    for r in range(4):
        order = sorted(range(len(x)), key=lambda i: hashlib.md5(f"{i}:7:{r}".encode()).hexdigest())
        c = x[order[:3]]
        for _ in range(300):
            own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            new = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(3)])
            moved, c = ((new - c) ** 2).sum(), new
            if moved <= 1e-4:
                break
        d = ((x[:, None] - c) ** 2).sum(2)
        if best is None or d.min(1).sum() < best[0]:
            best = (d.min(1).sum(), sorted(c.tolist()))
    own = ((x[:, None] - np.array(best[1])) ** 2).sum(2).argmin(1).tolist()
    for n in (3, 8):
        out = C.kmeans(df.repartition(n), ["a", "b"], k=3, n_init=4, seed=7)
        assert [r["kmlabel"] for r in out.orderBy("id").collect()] == own
    curve = {r["k"]: r["sse"] for r in C.sse_curve(df, ["a", "b"], max_cluster=3, n_init=4, seed=7).collect()}
    assert abs(curve[3] - best[0]) < 1e-9 and curve[1] > curve[2] > curve[3]
