"""Clustering: standardise, k-means (MLlib), SSE sweep, elbow, assignment.

* ``standardize``: one aggregate pass for mean and *population* std per
  column (a single row, folded into the projection as literals); a constant
  column becomes 0.
* ``kmeans``: Lloyd's iterations from random rows, ``n_init`` restarts, the
  lowest cost wins (ties: lowest restart). The first centres of a restart are
  the k rows with the smallest MD5 of (key, seed, restart), so they don't
  depend on partitions, and those of a smaller k are the first ones of a larger
  k: one pass serves a sweep. The points are dealt by ranges and packed into
  blocks of neighbours once (``point_blocks``); all restarts, and all k of a sweep,
  share each pass over the persisted blocks: a task turns them into sums per (fit,
  cluster) with NumPy, Spark adds them up, and a few rows per fit come back.
* ``binned_sse_curve`` / ``elbow_frame``: an SSE curve as a table and the
  knee of a convex decreasing curve (Kneedle, sensitivity 1) with window
  functions over that table (one row per k, so one small partition).
* ``assign_clusters``: nearest centre with the lowest centre id on ties; the
  k centres are literals in the expression, so there is no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ClusteringInputError, ElbowUndefined
from ..functions.text import col_of
from ..sources.files import local_frame
from . import point_blocks as B
from .projection import numeric_columns, require_columns


def standardize(df: DataFrame, cols, keep=(), prefix: str = "") -> DataFrame:
    """``(x - mean) / std_pop`` per column as double; constant columns give 0.

    Output: the ``keep`` columns, then each feature as ``prefix + name``.
    """
    cols = list(cols)
    require_columns(df, cols + list(keep))
    aggs = []
    for i, c in enumerate(cols):
        x = col_of(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"), F.count_if(x.isNull()).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    nulls = [c for i, c in enumerate(cols) if row[f"n{i}"]]
    if nulls:
        raise ClusteringInputError(f"feature column(s) contain nulls: {', '.join(nulls)}")
    out = []
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        x = col_of(c).cast("double")
        z = F.lit(0.0) if (s is None or s == 0) else (x - F.lit(m)) / F.lit(s)
        out.append(z.alias(prefix + c))
    return df.select(*[col_of(k) for k in keep], *out)


def centers_from_rows(df: DataFrame, cols):
    """Centres as a list of float lists from a frame that holds one row per centre."""
    rows = df.select(*[col_of(c).cast("double") for c in cols]).collect()
    return [[float(v) for v in r] for r in rows]


def assign_clusters(df: DataFrame, cols, centers, out: str = "cluster") -> DataFrame:
    """Index of the nearest centre (squared Euclidean), lowest index on ties."""
    cols = list(cols)
    dists = []
    for j, cen in enumerate(centers):
        d = None
        for c, v in zip(cols, cen):
            t = (col_of(c).cast("double") - F.lit(float(v)))
            t = t * t
            d = t if d is None else d + t
        dists.append(F.struct(d.alias("d"), F.lit(j).alias("j")))
    return df.withColumn(out, F.array_min(F.array(*dists))["j"])


def total_sse(df: DataFrame, cols) -> DataFrame:
    """SSE for k = 1 (sum of squared deviations from the column means)."""
    cols = list(cols)
    aggs = [(F.var_pop(col_of(c).cast("double")) * F.count(col_of(c))).alias(f"v{i}") for i, c in enumerate(cols)]
    s = None
    for i in range(len(cols)):
        s = F.col(f"v{i}") if s is None else s + F.col(f"v{i}")
    return df.agg(*aggs).select(s.alias("sse"))


def binned_sse_curve(df: DataFrame, col: str, max_k: int = 10) -> DataFrame:
    """SSE of ``col`` split into k equal-width bins, for k = 1..max_k.

    Rows are counted per distinct value first; only that table is replicated
    ``max_k`` times. The within-bin squares come from sums about the column's mean.
    """
    x = col_of(col).cast("double")
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    width = (hi - lo) if hi is not None and hi != lo else 1.0
    mean = df.agg(F.avg(x)).first()[0] or 0.0
    values = df.select(x.alias("_x")).filter(F.col("_x").isNotNull()).groupBy("_x").agg(F.count(F.lit(1)).alias("_c"))
    rep = values.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max_k))))
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width) * F.col("k")), F.col("k") - 1)
    off = F.col("_x") - F.lit(mean)
    per_bin = rep.groupBy("k", b.alias("bin")).agg(
        F.sum("_c").alias("n"), F.sum(off * F.col("_c")).alias("s"), F.sum(off * off * F.col("_c")).alias("q"))
    return per_bin.groupBy("k").agg(F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("sse"))


def elbow_frame(curve: DataFrame, k_col: str = "k", sse_col: str = "sse", sensitivity: float = 1.0) -> DataFrame:
    """Mark the knee of a convex decreasing SSE curve (column ``is_elbow``).

    Normalise k and SSE to [0, 1], flip SSE, take the difference curve d;
    local maxima/minima compare with neighbours (an end point with its one
    neighbour); a maximum sets threshold ``d - S * mean step of x``, a
    minimum resets it to 0; the knee is the latest maximum at the first row
    whose successor falls below the threshold.
    """
    w_all = Window.partitionBy()
    w = Window.partitionBy().orderBy(k_col)
    t = curve.select(col_of(k_col).alias("k"), col_of(sse_col).cast("double").alias("sse"))
    t = (t.withColumn("_x", (F.col("k") - F.min("k").over(w_all)) / (F.max("k").over(w_all) - F.min("k").over(w_all)))
          .withColumn("_yn", (F.col("sse") - F.min("sse").over(w_all)) / (F.max("sse").over(w_all) - F.min("sse").over(w_all)))
          .withColumn("_d", (F.lit(1.0) - F.col("_yn")) - F.col("_x"))
          .withColumn("_i", F.row_number().over(w) - 1)
          .withColumn("_n", F.count(F.lit(1)).over(w_all)))
    dp, dn = F.lag("_d").over(w), F.lead("_d").over(w)
    t = (t.withColumn("_max", (F.col("_d") >= F.coalesce(dp, F.col("_d"))) & (F.col("_d") >= F.coalesce(dn, F.col("_d"))))
          .withColumn("_min", (F.col("_d") <= F.coalesce(dp, F.col("_d"))) & (F.col("_d") <= F.coalesce(dn, F.col("_d"))))
          .withColumn("_next", dn)
          .withColumn("_step", F.lit(1.0) / (F.col("_n") - 1)))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = (t.withColumn("_lm", F.max(F.when(F.col("_max"), F.col("_i"))).over(run))
          .withColumn("_ln", F.max(F.when(F.col("_min"), F.col("_i"))).over(run)))
    # threshold of the latest maximum, looked up by its index
    t = t.withColumn("_tmx_at", F.when(F.col("_max"), F.col("_d") - F.lit(sensitivity) * F.col("_step")))
    t = t.withColumn("_thr_max", F.last("_tmx_at", ignorenulls=True).over(run))
    thr = F.when(F.col("_ln").isNotNull() & (F.col("_ln") >= F.col("_lm")), F.lit(0.0)).otherwise(F.col("_thr_max"))
    fire = F.col("_lm").isNotNull() & F.col("_next").isNotNull() & (F.col("_next") < thr)
    t = t.withColumn("_fire", fire)
    first_fire = F.min(F.when(F.col("_fire"), F.col("_i"))).over(w_all)
    knee_i = F.first(F.when(F.col("_i") == first_fire, F.col("_lm")), ignorenulls=True).over(w_all)
    return t.select("k", "sse", (F.col("_i") == knee_i).alias("is_elbow"))


def elbow(curve: DataFrame, k_col: str = "k", sse_col: str = "sse", sensitivity: float = 1.0) -> int:
    """The elbow k, or ``ElbowUndefined`` when the curve has no knee."""
    rows = elbow_frame(curve, k_col, sse_col, sensitivity).filter("is_elbow").select("k").collect()
    if not rows:
        raise ElbowUndefined("no elbow on this SSE curve (flat, straight or too short)")
    return int(rows[0]["k"])


def _features(df: DataFrame, cols, key: str | None) -> DataFrame:
    """(_key, x0, x1, ...): the key as text and the features as doubles, dealt evenly once for the many
    passes (the input may be a single file, or a skewed join's output)."""
    name = F.coalesce(col_of(key).cast("string"), F.lit("")) if key else F.concat_ws("|", *[col_of(c) for c in cols])
    rows = df.select(name.alias("_key"), *[col_of(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return rows.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _first_centers(rows: DataFrame, dims: int, k: int, n_init: int, seed: int):
    """For each restart, the ``k`` rows with the smallest MD5 of (key, seed, restart), in that order.

    A task keeps ``k`` rows per restart: ordered limits, no sort of all rows."""
    import numpy as np

    columns = [f"x{i}" for i in range(dims)]

    def least(r: int) -> DataFrame:
        hashed = rows.select(F.md5(F.concat_ws(":", "_key", F.lit(seed), F.lit(r))).alias("h"), *columns)
        return hashed.orderBy("h", *columns).limit(k).withColumn("_r", F.lit(r))

    found = reduce(DataFrame.unionAll, [least(r) for r in range(n_init)]).collect()  # n_init * k rows
    chosen = [sorted((r["h"], *[r[c] for c in columns]) for r in found if r["_r"] == j) for j in range(n_init)]
    return [np.array([r[1:] for r in of_restart]) for of_restart in chosen]


def _blocks(rows: DataFrame, dims: int) -> DataFrame:
    """The points in blocks of neighbours (see ``point_blocks``): ranges of the first columns go to tasks, and a
    task packs them by chunks of bounded size."""
    columns = [f"x{i}" for i in range(dims)]

    def step(batches):
        import numpy as np
        import pyarrow as pa

        def packed(x):
            held, points = B.pack(x)
            for i in range(0, len(held), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(held[i:i + 1000], pa.binary()), pa.array(points[i:i + 1000], pa.binary())], names=["held", "points"])

        chunk, n, most = [], 0, B.CHUNK_BYTES // (8 * dims)
        for batch in batches:
            chunk.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(dims)], 1))
            n += len(chunk[-1])
            if n >= most:
                yield from packed(np.concatenate(chunk))
                chunk, n = [], 0
        if n:
            yield from packed(np.concatenate(chunk))

    ranged = rows.repartitionByRange(rows.sparkSession.sparkContext.defaultParallelism, *columns, "_key")
    return ranged.select(*columns).mapInArrow(step, "held binary, points binary")


def _pass(blocks: DataFrame, dims: int, fits: dict):
    """One pass over ``blocks`` for several fits ``{number: centres}``: for each, per cluster the number
    of rows nearest to its centre and their sums, and the cost."""
    import numpy as np

    columns = [f"x{i}" for i in range(dims)]

    def step(batches):
        import pyarrow as pa

        made = {m: [np.zeros(len(c)), np.zeros((len(c), dims)), 0.0] for m, c in fits.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            held, points = [np.frombuffer(b"".join(batch.column(i).to_pylist())) for i in range(2)]
            held, points = held.reshape(batch.num_rows, -1), points.reshape(batch.num_rows, dims, -1)
            for m, c in fits.items():
                for i, v in enumerate(B.add_up(held, points, c)):
                    made[m][i] = made[m][i] + v
        rows_ = [(m, j, n[j], *s[j], cost if j == 0 else 0.0) for m, (n, s, cost) in made.items() for j in range(len(n))]
        names = ["fit", "cluster", "n", *columns, "cost"]
        types = [pa.int32(), pa.int32(), *[pa.float64()] * (dims + 2)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows_], t) for i, t in enumerate(types)], names=names)

    schema = "fit int, cluster int, n double, " + ", ".join(f"{c} double" for c in columns) + ", cost double"
    parts = blocks.mapInArrow(step, schema)
    sums = parts.groupBy("fit", "cluster").agg(*[F.sum(c).alias(c) for c in ["n", *columns, "cost"]]).collect()
    out = {m: [np.zeros(len(c)), np.zeros((len(c), dims)), 0.0] for m, c in fits.items()}
    for r in sums:
        n, s, _ = out[r["fit"]]
        n[r["cluster"]] = r["n"]
        s[r["cluster"]] = [r[c] for c in columns]
        out[r["fit"]][2] += r["cost"]
    return out


def _best_fits(rows: DataFrame, dims: int, ks, n_init: int, max_iter: int, seed: int, tol: float) -> dict:
    """``{k: (cost, centres)}`` of the best restart for each k; centres in lexicographic order."""
    import numpy as np

    first = _first_centers(rows, dims, max(ks), n_init, seed)
    centers = {(k, j): c[:k] for k in ks for j, c in enumerate(first)}
    moving = dict(centers)
    blocks = _blocks(rows, dims).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(max_iter):
            numbered = dict(enumerate(moving))
            made = _pass(blocks, dims, {i: moving[m] for i, m in numbered.items()})
            still = {}
            for i, m in numbered.items():
                n, s, _cost = made[i]
                new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], moving[m])
                centers[m] = new
                if ((new - moving[m]) ** 2).sum() > tol:  # features are standardised: mean variance 1
                    still[m] = new
            moving = still
            if not moving:
                break
        numbered = dict(enumerate(centers))
        costs = _pass(blocks, dims, {i: centers[m] for i, m in numbered.items()})
    finally:
        blocks.unpersist()
    best: dict = {}
    for k in ks:  # costs that differ by rounding only are equal: the lowest restart
        of_k = {j: costs[i][2] for i, (k_, j) in numbered.items() if k_ == k}
        j = min(j for j, cost in of_k.items() if cost <= min(of_k.values()) * (1 + 1e-12))
        best[k] = (of_k[j], sorted(centers[k, j].tolist()))
    return best


def _check_rows(rows: DataFrame, k: int) -> None:
    if rows.limit(k).count() < k:
        raise ClusteringInputError(f"fewer rows than clusters (k={k})")


def sse_curve(df: DataFrame, cols, max_cluster: int = 10, n_init: int = 10, max_iter: int = 300,
              seed: int = 40, key: str | None = "id", tol: float = 1e-4) -> DataFrame:
    """Best-of-``n_init`` SSE for k = 1..max_cluster as a small table ``(k, sse)``."""
    cols = list(cols)
    rows = _features(df, cols, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _check_rows(rows, max_cluster)
        sse = [(1, float(total_sse(df, cols).first()["sse"]))]
        best = _best_fits(rows, len(cols), list(range(2, max_cluster + 1)), n_init, max_iter, seed, tol)
        sse += [(k, float(best[k][0])) for k in sorted(best)]
    finally:
        rows.unpersist()
    return local_frame(df.sparkSession, sse, "k int, sse double")


def kmeans(df: DataFrame, cols, k: int, n_init: int = 10, max_iter: int = 300, seed: int = 40,
           key: str = "id", out: str = "kmlabel", tol: float = 1e-4) -> DataFrame:
    """``df`` plus label column ``out`` from the best of ``n_init`` random-init
    fits (the fitted centres are folded into the label expression)."""
    cols = list(cols)
    rows = _features(df, cols, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _check_rows(rows, k)
        centers = _best_fits(rows, len(cols), [k], n_init, max_iter, seed, tol)[k][1]
    finally:
        rows.unpersist()
    return assign_clusters(df, cols, centers, out)


def km(df: DataFrame, cols=None, n_cluster: int | None = None, drop=("user-id",), max_cluster: int = 10,
       n_init: int = 10, max_iter: int = 300, seed: int = 40, key: str = "id", out: str = "kmlabel",
       standardise: bool = True) -> DataFrame:
    """Full clustering step: pick features, standardise, choose k by the
    elbow when ``n_cluster`` is None, fit, and return ``df`` with ``out``."""
    if cols is None:
        cols = [c for c in numeric_columns(df, drop) if c != key]
    cols = list(cols)
    if standardise:
        z = standardize(df, cols, keep=df.columns, prefix="_z_")
        zcols = ["_z_" + c for c in cols]
    else:
        z, zcols = df, cols
    if n_cluster is None:
        n_cluster = elbow(sse_curve(z, zcols, max_cluster, n_init, max_iter, seed, key))
    labelled = kmeans(z, zcols, n_cluster, n_init, max_iter, seed, key, out)
    return labelled.drop(*[c for c in zcols if c not in cols])
