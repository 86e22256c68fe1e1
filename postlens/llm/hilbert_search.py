"""Approximate nearest neighbours by shifted space-filling curves.

Each of ``curves`` Hilbert orderings sorts the vectors by the Hilbert key of a random projection to
``dims`` dimensions, randomly rotated and shifted. Spark range-partitions each ordering; ranks come
from prefix sums over partitions, and ranks are cut into blocks of ``block`` vectors. A query is
compared with its own block and ``reach`` blocks to either side on every curve; the windows' best are
merged and ranked by the exact distance. Own blocks go first: their best bound what others send on.

``reach`` is set by measurement: a bounded sample of the queries is searched by brute force, and the
least reach is taken at which their true neighbours lie in the windows with the target recall.
So it grows where the data have no structure, and there is no cap on candidates.

Equal vectors are one class from the start (its ``k`` + 1 smallest ids are kept, which is all that
any answer can need), so a vector that a third of all rows hold is one point on each curve.

Defined cases: null, zero, non-finite vectors and those with null components or of another length
than the commonest one take no part, neither as query nor as neighbour; null ids take no part; ties
go to the smaller id; repeated rows (same id and vector) count once; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written


@dataclass(frozen=True)
class CurveRules:
    """``sample``: queries searched by brute force to set the reach (a bound); ``recall``: their
    target; ``bits`` a dimension (``dims`` * ``bits`` at most 62)."""

    curves: int = 16
    dims: int = 8
    bits: int = 6
    block: int = 256
    sample: int = 128
    recall: float = 0.95
    seed: int = 11

    def projections(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(curves, length, dims) orthonormal columns where length allows, and (curves, dims) shifts."""
        rng = np.random.default_rng(self.seed)
        made = [np.linalg.qr(rng.normal(size=(max(length, self.dims), self.dims)))[0][:length] for _ in range(self.curves)]
        return np.array(made), rng.random((self.curves, self.dims)) / 2


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``points`` (unsigned integers of ``bits`` bits) on the Hilbert curve:
    undo the curve's rotations from the highest bit down, Gray-decode, interleave the bits."""
    x = points.astype(np.int64).T.copy()
    dims, top = len(x), 1 << (bits - 1)
    level = top
    while level > 1:
        below = level - 1
        for i in range(dims):
            inside = (x[i] & level) > 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(inside, below, swap)
            x[i] ^= swap if i else 0
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = top
    while level > 1:
        flip ^= np.where((x[-1] & level) > 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances, queries by rows, by direct differences in doubles."""
    return np.sqrt(((queries[:, None, :] - rows[None, :, :]) ** 2).sum(axis=2))


def nearest(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, distance) of each query's ``k`` nearest rows, ties to smaller ids; in steps of
    bounded size."""
    by_id = np.argsort(ids, kind="stable")
    rows, ids = rows[by_id], ids[by_id]
    step = max(1, 2_000_000 // max(1, rows.size))
    out = []
    for a in range(0, len(queries), step):
        d = distances(queries[a : a + step], rows)
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        out += [(a + i, ids[o], d[i, o]) for i, o in enumerate(order)]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return np.repeat([i for i, _, _ in out], [len(x) for _, x, _ in out]), np.concatenate([x for _, x, _ in out]), np.concatenate([d for _, _, d in out])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(finite & F.exists(v, lambda x: x != 0))
    length = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(v) == (length["n"] if length else 0)).distinct()


def positions(points: DataFrame, length: int, rules: CurveRules) -> DataFrame:
    """(id, blocks): the block of each vector on each curve."""
    matrices, shifts = rules.projections(length)
    flat = np.concatenate(list(matrices), axis=1)  # length x (curves * dims)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(flat.shape[1]), np.zeros(flat.shape[1])
        for batch in batches:
            if len(batch):
                p = matrix(batch.column(0)) @ flat
                n, total, square = n + len(p), total + p.sum(axis=0), square + (p**2).sum(axis=0)
        at = np.arange(flat.shape[1], dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), n)), pa.array(total), pa.array(square)], names=["at", "n", "total", "square"])

    sums = points.select("vec").mapInArrow(moments, "at int, n long, total double, square double")
    sums = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square")).orderBy("at").collect()  # curves * dims rows
    n = sums[0]["n"]
    mean = np.array([s["total"] for s in sums]) / n
    spread = np.sqrt(np.maximum(np.array([s["square"] for s in sums]) / n - mean**2, 1e-18))
    cells = 1 << rules.bits

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            z = ((matrix(batch.column(1)) @ flat - mean) / spread).reshape(len(batch), rules.curves, rules.dims)
            cell = np.clip((np.clip((z + 4) / 8, 0, 1) / 2 + shifts) * cells, 0, cells - 1).astype(np.int64)
            for c in range(rules.curves):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), c, np.int32)), pa.array(hilbert_keys(cell[:, c], rules.bits)), batch.column(0)], names=["curve", "key", "id"])

    by = ["curve", "key", "id"]
    ordered = points.select("id", "vec").mapInArrow(keys, "curve int, key long, id long").repartitionByRange(*by).sortWithinPartitions(*by)
    stepped = written(ordered.select("curve", "id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("step")), "curve-order")
    parts = stepped.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("first"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.col("base") + F.col("step") - F.col("first") - F.col("curve") * F.lit(n)  # every curve has all n vectors
    ranked = stepped.join(F.broadcast(based), "part").select("id", "curve", F.floor(rank / rules.block).cast("long").alias("block"))
    return ranked.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("curve", "block"))), lambda s: s["block"]).alias("blocks"))


def measured_reach(points: DataFrame, placed: DataFrame, asked: Column, k: int, rules: CurveRules) -> int:
    """The least reach at which the windows hold the target share of the true neighbours of a
    bounded sample of the queries (the first by a hash of their id)."""
    some = placed.filter("asked").orderBy(F.xxhash64("id"), "id").limit(rules.sample).select("id", "vec", "blocks").collect()
    if not some:
        return 0
    queries, numbers = np.array([r["vec"] for r in some], np.float64), np.array([r["id"] for r in some])

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                q, i, d = nearest(queries, matrix(batch.column(1)), batch.column(0).to_numpy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(numbers[q]), pa.array(i), pa.array(d)], names=["query", "id", "d"])

    pairs = points.select("id", "vec").mapInArrow(brute, "query long, id long, d double").filter("query <> id")
    best = Window.partitionBy("query").orderBy("d", "id")
    true = pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") < k).select("query", "id")
    found = true.join(placed.select("id", "blocks"), "id").select("query", "blocks").collect()  # sample * k rows at most
    own = {r["id"]: np.array(r["blocks"]) for r in some}
    needed = sorted(int(np.abs(own[r["query"]] - np.array(r["blocks"])).min()) for r in found)
    return needed[min(len(needed) - 1, int(np.ceil(rules.recall * len(needed))) - 1)] if needed else 0


def search(vectors: DataFrame, asked: Column, k: int = 10, rules: CurveRules = CurveRules(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` where ``asked`` (an expression over the
    column ``id``) holds: their ``k`` nearest found, without the row itself."""
    rows = written(usable(vectors, id_col, vector_col), "vectors")
    nth = Window.partitionBy("vec").orderBy("id")
    kept = rows.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k + 1)
    classes = written(kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members")).select(F.col("members")[0].alias("id"), "vec", "members"), "vector-classes")
    queries = rows.filter(asked).select(F.col("id").alias("query_id"), "vec").join(classes.select("id", "vec"), "vec").select("query_id", "id")
    queries = written(queries, "query-classes")
    empty = "query_id long, rank int, vec_id long, score double"
    first = classes.select(F.size("vec").alias("n")).first()
    if first is None:
        return rows.sparkSession.createDataFrame([], empty)
    points = classes.select("id", "vec")
    marked = queries.select(F.col("id").alias("__q")).distinct()
    at = points.join(positions(points, first["n"], rules), "id").join(marked, F.col("id") == F.col("__q"), "left")
    placed = written(at.withColumn("asked", F.col("__q").isNotNull()).drop("__q"), "curve-positions")
    reach = measured_reach(points, placed, asked, k + 1, rules)
    spread = placed.select("id", "vec", "asked", F.posexplode("blocks").alias("curve", "block"))
    none = F.lit(float("inf"))
    own = spread.select("curve", "block", "id", "vec", F.lit(False).alias("query"), none.alias("bound"))

    def compare(table: pa.Table) -> pa.Table:
        query, ids, vec, bound = table["query"].to_numpy(), table["id"].to_numpy(), matrix(table["vec"]), table["bound"].to_numpy()
        q, i, d = nearest(vec[query], vec[~query], ids[~query], k + 1)
        near = d <= bound[query][q]
        return pa.table({"query": pa.array(ids[query][q][near], pa.int64()), "id": pa.array(i[near], pa.int64()), "d": pa.array(d[near], pa.float64())})

    def compared(sent: DataFrame) -> DataFrame:
        return own.unionByName(sent).groupBy("curve", "block").applyInArrow(compare, "query long, id long, d double").distinct()

    # own blocks first: what lies beyond the k + 1 nearest found there can't be an answer
    asking = spread.filter("asked").select("curve", "block", "id", "vec", F.lit(True).alias("query"))
    found = written(compared(asking.withColumn("bound", none)), "own-blocks")
    if reach:
        nth = F.row_number().over(Window.partitionBy("query").orderBy("d", "id"))
        bounds = found.withColumn("n", nth).filter(F.col("n") == k + 1).select(F.col("query").alias("__q"), F.col("d").alias("bound"))
        step = F.explode(F.array_remove(F.sequence(F.lit(-reach), F.lit(reach)), 0))
        sent = asking.withColumn("step", step).withColumn("block", F.col("block") + F.col("step")).filter("block >= 0").drop("step")
        sent = sent.join(bounds, F.col("id") == F.col("__q"), "left").drop("__q").withColumn("bound", F.coalesce("bound", none))
        found = found.unionByName(compared(sent)).distinct()
    merged = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("d", "id"))).filter(F.col("n") <= k + 1)
    named = merged.join(classes.select("id", "members"), "id").select("query", "d", F.explode("members").alias("vec_id"))
    answers = queries.join(named, F.col("id") == F.col("query")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("score"))
