"""A flattened store of posts by day: captures are parsed once, batch chains prune by date.

``start_store`` is a streaming job: raw lines -> VARIANT -> declared paths as typed columns -> Parquet in
one folder a day (UTC) of the post's date. The file sink's log makes it exactly once over restarts.
``read_store`` filters on the day before the time, so a time range reads its days only. The store's rows
are what ``flatten`` gives, so ``prepare_posts(flat=...)`` and every other operator take them as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import col_of
from ..operators.filters import between_times
from ..operators.projection import flatten
from ..sources.jsonl import parse_lines

DAY = "day"


def start_store(spark: SparkSession, source, out_dir: str, checkpoint: str, paths=K.PATHS_SHORT, date: str = "created_at",
                available_now: bool = False, every: str | None = None, **flatten_options):
    """Starts the job. ``source``: a folder of capture files, or a streaming frame with a column ``value``."""
    lines = spark.readStream.format("text").load(source) if isinstance(source, str) else source
    flat = flatten(parse_lines(lines), paths, date=date, validate=False, **flatten_options)
    w = flat.withColumn(DAY, F.to_date(col_of(date))).writeStream.format("parquet").partitionBy(DAY).outputMode("append")
    w = w.option("checkpointLocation", checkpoint).option("path", out_dir)
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    return w.start()


def read_store(spark: SparkSession, out_dir: str, start=None, end=None, date: str = "created_at", keep_day: bool = False) -> DataFrame:
    """The posts of the store; with ``start`` and ``end`` (timestamps with an offset) those strictly
    between, of whose days alone the files are read."""
    rows = spark.read.parquet(out_dir)
    if start is not None and end is not None:
        first, last = (F.to_date(F.lit(t).cast("timestamp")) for t in (start, end))
        rows = between_times(rows.filter((F.col(DAY) >= first) & (F.col(DAY) <= last)), start, end, date)
    return rows if keep_day else rows.drop(DAY)
