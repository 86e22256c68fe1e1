"""Totals of a running stream: stateful aggregates with a table sink that batch jobs read.

``start_totals`` runs any batch aggregate of this library (``group_label_counts``, ``describe_by``,
``value_counts`` without its order, ...) on a stream. Spark keeps one state row a key in the checkpoint, with
partial aggregation per micro-batch, so a hot key costs one row a task.

Two modes, both with one folder a batch under ``<out_dir>/<name>``, replaced if the batch is tried again:

* ``update``: a batch writes the keys that it changed. ``read_totals`` takes each key's last row.
* ``complete``: a batch writes all keys, for small key sets. ``read_totals`` takes the last batch.

So the totals survive restarts, and equal the batch aggregate over the same files. The majority label and
the joins onto the state table read them like any other frame (``stats.majority_of_counts``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col_of
from ..operators.stats import describe_by, group_label_counts
from .capture import route_messages

MODES = ("update", "complete")


def start_totals(stream: DataFrame, aggregate: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str, name: str = "totals",
                 mode: str = "update", available_now: bool = False, every: str | None = None):
    """Starts the query; ``aggregate`` maps the stream to a grouped aggregate. Returns the ``StreamingQuery``."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    folder = f"{out_dir.rstrip('/')}/{name}"

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    w = aggregate(stream).writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    return w.start()


def read_totals(spark: SparkSession, out_dir: str, keys, name: str = "totals", mode: str = "update") -> DataFrame | None:
    """The totals as of the last finished batch, or None if there is none yet. ``keys``: the grouping columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    try:
        rows = spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None
    if mode == "complete":
        last = rows.agg(F.max("batch")).scalar()
        return rows.filter(F.col("batch") == last).drop("batch")
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    held = F.max_by(F.struct(*[col_of(c).alias(f"v{i}") for i, c in enumerate(values)]), "batch").alias("_v")
    return rows.groupBy(*[col_of(k) for k in keys]).agg(held).select(*[col_of(k) for k in keys], *[F.col(f"_v.v{i}").alias(c) for i, c in enumerate(values)])


def label_totals(by=("state", "label"), count_col: str = "user-id", out: str = "n") -> Callable[[DataFrame], DataFrame]:
    """Posts a (state, label), for the majority label."""
    return lambda posts: group_label_counts(posts, by, count_col, out)


def sentiment_totals(value: str = "full_text-sentiment-compound", by: str = "state", prefix: str = "") -> Callable[[DataFrame], DataFrame]:
    """Count, mean and standard deviation of a score a state."""
    return lambda posts: describe_by(posts, by, value, ("count", "mean", "std"), prefix=prefix)


def value_totals(col: str, out: str = "n") -> Callable[[DataFrame], DataFrame]:
    """Frequencies of a column's values, nulls dropped."""
    return lambda posts: posts.filter(col_of(col).isNotNull()).groupBy(col_of(col).alias(col)).agg(F.count(F.lit(1)).alias(out))


def message_totals(lines: DataFrame, col: str = "value") -> DataFrame:
    """Messages of each kind in raw capture lines, and the posts that the source withheld (its counter is
    cumulative, so the largest is the total)."""
    track = F.try_variant_get(F.try_parse_json(F.when(F.col("kind") == "limit", col_of(col))), "$.limit.track", "bigint")
    return route_messages(lines, col, "kind").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max(track).alias("missed"))
