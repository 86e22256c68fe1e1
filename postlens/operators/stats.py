"""Aggregations and their joins onto the state table.

Every aggregate here is a single ``groupBy().agg()`` with map-side partial
aggregation, so a hot group (one state holding a third of all posts) is
pre-combined in each task before the shuffle and never collected whole.
Exact quartiles use Spark's ``percentile``, whose buffer holds one entry per
*distinct* value, on bounded-domain columns (rounded scores). For unbounded
ones ``ranked=True`` gives the same numbers by ranks (``exact_quantiles``), and
``approx=True`` a sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_of
from ..session import materialize
from .projection import require_columns

ALL_STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _stat(name: str, c, approx: bool, accuracy: int):
    if name == "count":
        return F.count(c)
    if name == "mean":
        return F.avg(c)
    if name == "std":
        return F.stddev_samp(c)
    if name == "min":
        return F.min(c)
    if name == "max":
        return F.max(c)
    if name.startswith("p"):
        q = int(name[1:]) / 100.0
        if approx:
            return F.percentile_approx(c, q, accuracy)
        return F.percentile(c, F.lit(q))
    raise ValueError(name)


def describe_by(df: DataFrame, by, value: str, stats=ALL_STATS, approx: bool = False,
                accuracy: int = 10000, prefix: str = "", ranked: bool = False) -> DataFrame:
    """Grouped count/mean/std/min/quartiles/max of ``value`` (nulls ignored,
    rows with a null key dropped, as a pandas group-by does). ``ranked``: the
    quartiles by ranks, so that no task holds a group's distinct values."""
    by = [by] if isinstance(by, str) else list(by)
    require_columns(df, by + [value])
    c = col_of(value).cast("double")
    keyed = df
    for b in by:
        keyed = keyed.filter(col_of(b).isNotNull())
    ranks = [s for s in stats if ranked and s.startswith("p")]
    aggs = [_stat(s, c, approx, accuracy).alias(prefix + s) for s in stats if s not in ranks]
    keys = [col_of(b) for b in by]
    out = keyed.groupBy(*keys).agg(*(aggs or [F.count(F.lit(1)).alias("_rows")]))
    if ranks:
        spread = exact_quantiles(keyed, by, value, {prefix + s: int(s[1:]) / 100.0 for s in ranks})
        names = [f"_k{i}" for i in range(len(by))]
        spread = spread.toDF(*names, *spread.columns[len(by):])
        same = reduce(lambda a, b: a & b, [col_of(b) == F.col(n) for b, n in zip(by, names, strict=True)])
        out = out.join(spread, same, "left")
    return out.select(*keys, *[prefix + s for s in stats])


def exact_quantiles(df: DataFrame, by, value: str, probs: dict[str, float]) -> DataFrame:
    """``by`` and a column for each of ``probs`` (name: probability): linearly interpolated quantiles of
    the non-null values, equal to ``percentile``, for groups of any number of distinct values.

    Counts per (group, value) are sorted over range partitions; sums per (partition, group) give each
    partition's first rank; a running sum inside a (partition, group) gives each value's ranks, and the
    two values at a quantile's ranks are picked by a partial aggregate. So a task holds a part of a
    group only, and a group whose rows are all in one state is spread over all tasks."""
    by = [by] if isinstance(by, str) else list(by)
    keys = [f"_g{i}" for i in range(len(by))]
    rows = df.select(*[col_of(b).alias(k) for b, k in zip(by, keys, strict=True)], col_of(value).cast("double").alias("_x")).filter("_x IS NOT NULL")
    counts = rows.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    placed = counts.repartitionByRange(*keys, "_x").withColumn("_part", F.spark_partition_id())
    placed = materialize(placed)  # ranges come from a sample: the partition numbers must not change
    parts = placed.groupBy(*keys, "_part").agg(F.sum("_c").alias("_n"))
    # one row a (group, partition): as many rows a group as there are partitions
    run = Window.partitionBy(*keys).orderBy("_part")
    parts = parts.select(*keys, "_part", (F.sum("_n").over(run) - F.col("_n")).alias("_begin"), F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"))
    inside = Window.partitionBy("_part", *keys).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("_end", F.sum("_c").over(inside))
    on = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in ["_part", *keys]])
    ranked = ranked.alias("r").join(parts.alias("p"), on).select(*[F.col(f"r.{k}").alias(k) for k in keys], "_x", "_total",
                                                                   (F.col("_begin") + F.col("_end")).alias("_end"), (F.col("_begin") + F.col("_end") - F.col("_c")).alias("_first"))
    aggs = [F.max("_total").alias("_total")]
    place = {name: (F.col("_total") - 1) * F.lit(p) for name, p in probs.items()}
    for i, at in enumerate(place.values()):
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_end")), F.col("_x"))).alias(f"_{side}{i}"))
    made = ranked.groupBy(*keys).agg(*aggs)
    out = []
    for i, (name, at) in enumerate(place.items()):
        between = (F.ceil(at) - at) * F.col(f"_lo{i}") + (at - F.floor(at)) * F.col(f"_hi{i}")
        out.append(F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(between).alias(name))
    return made.select(*[F.col(k).alias(b) for k, b in zip(keys, by, strict=True)], *out)


def group_label_counts(df: DataFrame, by=("state", "label"), count_col: str = "user-id",
                       out: str = "n") -> DataFrame:
    """Non-null ``count_col`` per group; rows with a null key are dropped."""
    by = list(by)
    require_columns(df, by + [count_col])
    keyed = df
    for b in by:
        keyed = keyed.filter(col_of(b).isNotNull())
    return keyed.groupBy(*[col_of(b) for b in by]).agg(F.count(col_of(count_col)).alias(out))


def majority_label(df: DataFrame, label: str = "label", state_col: str = "state",
                   count_col: str = "user-id", out: str | None = None) -> DataFrame:
    """Per state the label with the most posts (ties: smallest label).

    Groups with a zero count (only null ``count_col``) still compete, as in
    the pandas original. One aggregate to (state, label) counts, then
    ``min_by(label, (-count, label))`` per state: no window sort.
    """
    return majority_of_counts(group_label_counts(df, (state_col, label), count_col, "_n"), label, state_col, "_n", out)


def majority_of_counts(counts: DataFrame, label: str = "label", state_col: str = "state", n: str = "n", out: str | None = None) -> DataFrame:
    """The majority label from (state, label, count) rows, such as the totals of a running stream."""
    best = F.min_by(col_of(label), F.struct((-col_of(n)).alias("a"), col_of(label).alias("b")))
    return counts.groupBy(col_of(state_col)).agg(best.alias(out or f"cluster_max_{label}"))


def join_states(states: DataFrame, table: DataFrame, states_key: str = "name",
                table_key: str = "state") -> DataFrame:
    """Left join of an aggregated per-state table onto the state table.

    Every state is kept; absent states get nulls. The aggregated side has at
    most one row per state, and AQE turns this into a broadcast join from the
    measured shuffle size.
    """
    t = table.withColumnRenamed(table_key, "_jk")
    return states.join(t, col_of(states_key) == F.col("_jk"), "left").drop("_jk")


def state_sentiment(df: DataFrame, states: DataFrame, value: str = "full_text-sentiment-compound",
                    state_col: str = "state", states_key: str = "name") -> DataFrame:
    """count / mean / sample std of ``value`` per state, on every state row."""
    st = describe_by(df, state_col, value, ("count", "mean", "std"))
    return join_states(states, st, states_key, state_col)


def add_majority(states: DataFrame, df: DataFrame, label: str = "label", state_col: str = "state",
                 states_key: str = "name", count_col: str = "user-id", out: str | None = None) -> DataFrame:
    m = majority_label(df, label, state_col, count_col, out)
    return join_states(states, m, states_key, state_col)


def states_with_posts(states: DataFrame, df: DataFrame, states_key: str = "name",
                      state_col: str = "state", present: bool = True) -> DataFrame:
    """States that have (``left_semi``) or lack (``left_anti``) any post.

    The post side is reduced to its distinct states first (partial
    aggregation in every task), so a hot state never ships all its rows.
    """
    keys = df.select(col_of(state_col).alias("_jk")).filter(F.col("_jk").isNotNull()).distinct()
    return states.join(keys, col_of(states_key) == F.col("_jk"), "left_semi" if present else "left_anti")


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Frequency table, nulls dropped, most frequent first (ties by value)."""
    c = col_of(col)
    return (df.filter(c.isNotNull()).groupBy(c.alias(col)).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.desc(out), F.asc(col)))


def n_unique(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01):
    """Number of distinct non-null values as a one-row frame ``n_unique``."""
    c = col_of(col)
    agg = F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    return df.agg(agg.alias("n_unique"))


def histogram(df: DataFrame, col: str, subsets: dict | None = None, bins: int = 20) -> DataFrame:
    """Equal-width histogram per subset between the subset's own min and max.

    Bins are ``[lo + i*w, lo + (i+1)*w)``, the last one closed. If min equals
    max the range is widened by 0.5 on each side. Empty bins are emitted with
    count 0. Plan: one partial-aggregated count per (subset, value), read
    twice through one reused exchange: for the min/max per subset (a few
    rows, broadcast) and for the counts per bin.
    """
    subsets = subsets or {"all": F.lit(True)}
    x = col_of(col).cast("double")
    names = list(subsets)
    tagged = df.select(x.alias("_x"), *[F.coalesce(cond, F.lit(False)).alias(f"_s{i}")
                                         for i, cond in enumerate(subsets.values())])
    tagged = tagged.filter(F.col("_x").isNotNull())
    # subset index per row: a row can belong to several subsets
    exploded = tagged.select("_x", F.explode(F.filter(
        F.array(*[F.when(F.col(f"_s{i}"), F.lit(i)) for i in range(len(names))]),
        lambda v: v.isNotNull())).alias("_sub"))
    # pre-aggregate to (subset, value, count): the input is evaluated once and
    # both the range and the bin counts read this one (reused) exchange
    pre = exploded.groupBy("_sub", "_x").agg(F.count(F.lit(1)).alias("_c"))
    rng = pre.groupBy("_sub").agg(F.min("_x").alias("_lo0"), F.max("_x").alias("_hi0"))
    rng = rng.select("_sub",
                     F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")).alias("_lo"),
                     F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")).alias("_hi"))
    # one row per subset at most: bounded, so the range table is broadcast
    binned = pre.join(F.broadcast(rng), "_sub").select(
        "_sub", "_lo", "_hi", "_c",
        F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(bins)),
                F.lit(bins - 1)).cast("int").alias("bin"))
    counts = binned.groupBy("_sub", "bin").agg(F.sum("_c").alias("n"))
    grid = rng.select("_sub", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    names_arr = F.array(*[F.lit(n) for n in names])
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return (grid.join(counts, ["_sub", "bin"], "left")
            .select(F.element_at(names_arr, F.col("_sub") + 1).alias("subset"), "bin",
                    (F.col("_lo") + F.col("bin") * w).alias("lo_edge"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("hi_edge"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def ratios(df: DataFrame, lang_col: str = "lang", language: str = "en", place_col: str | None = None,
           state_col: str | None = None) -> DataFrame:
    """Share figures in one global aggregate.

    ``pct_non_lang``: per cent of rows not in ``language`` (null counts as not),
    rounded half-to-even; ``share_place`` / ``share_state``: non-null shares.
    """
    n = F.count(F.lit(1))
    aggs = [n.alias("n_rows"),
            F.bround(F.lit(100.0) * F.count_if(~col_of(lang_col).eqNullSafe(F.lit(language))) / n, 0)
            .alias("pct_non_lang")]
    if place_col:
        aggs.append((F.count(col_of(place_col)) / n).alias("share_place"))
    if state_col:
        aggs.append((F.count(col_of(state_col)) / n).alias("share_state"))
    return df.agg(*aggs)


def retention(initial: DataFrame, final: DataFrame) -> DataFrame:
    """Rows kept after cleaning, and the per cent of the initial rows."""
    tags = (initial.select(F.lit(0).alias("_t")).unionByName(final.select(F.lit(1).alias("_t"))))
    return (tags.agg(F.count_if(F.col("_t") == 0).alias("n_initial"),
                     F.count_if(F.col("_t") == 1).alias("n_final"))
            .withColumn("pct_kept", F.lit(100.0) * F.col("n_final") / F.col("n_initial")))


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def union_all(frames) -> DataFrame:
    """Concatenate frames by column name; missing columns become null."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

