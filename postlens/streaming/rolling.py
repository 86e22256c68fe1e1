"""A rolling text sink with an exact count cap, as a ``foreachBatch`` step.

Every kept line has a number: the count before its batch, which the sink's state holds, plus its
place in the batch. Places are prefix sums over the batch's partitions (their counts are the only thing
that reaches the driver) plus the row's number inside its partition, so no task reads all rows and no
global limit is needed. Line ``i`` belongs to file ``i div max_records``; lines from ``nb`` on are dropped.

A file is closed when it has ``max_records`` lines, not when a batch ends: the lines of the open file
(fewer than ``max_records``) are kept beside the state, and the next batch writes the file anew with
its own lines behind them. A file is a folder ``file=<prefix>_<yyyyMMdd-HHmmss>_<number>`` with one part;
the stamp is the time at which its first line's batch was first tried.

State (one row a batch: lines before, lines after, stamp) is written before the batch's files, and
everything is written under the batch's number, so a batch that is tried again gives the same files. A
mark behind the files says that the batch is done; only done lines count as written.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import local_frame

STATE = "batch long, before long, after long, stamp string, open_stamp string"
ROW_BITS = 33  # of monotonically_increasing_id, the row's number in its partition


def numbered(batch: DataFrame) -> tuple[DataFrame, int]:
    """``batch`` (kept in memory or on disk by the caller) with ``_seq`` from 0 on, and its row count."""
    at = F.monotonically_increasing_id()
    rows = batch.withColumn("_part", F.spark_partition_id()).withColumn("_at", at.bitwiseAND(F.lit((1 << ROW_BITS) - 1))).persist(StorageLevel.MEMORY_AND_DISK)
    counts = sorted((r["_part"], r["count"]) for r in rows.groupBy("_part").count().collect())
    begins, total = [], 0
    for part, n in counts:
        begins.append((part, total))
        total += n
    offsets = local_frame(batch.sparkSession, begins, "_part int, _begin long")
    return rows.join(F.broadcast(offsets), "_part").withColumn("_seq", F.col("_begin") + F.col("_at")).drop("_part", "_at", "_begin"), total


class RollingSink:
    """``step`` for ``foreachBatch``; ``state`` is a folder of the query's checkpoint."""

    def __init__(self, spark: SparkSession, folder: str, state: str, prefix: str, max_records: int, nb: int | None = None):
        self.spark, self.folder, self.state, self.prefix = spark, folder.rstrip("/"), state.rstrip("/"), prefix
        self.max_records = max_records if max_records and max_records > 0 else 0
        self.nb = nb if nb is not None and nb > 0 else None

    def _rows(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def states(self) -> dict[int, dict]:
        """The states of the last batches by batch; older ones are of no use."""
        rows = self._rows(f"{self.state}/batches", STATE)
        last = [] if rows is None else rows.orderBy(F.desc("batch")).limit(2).collect()
        return {r["batch"]: r.asDict() for r in last}

    def written(self) -> int:
        """Lines in finished files so far."""
        rows = self._rows(f"{self.state}/done", "after long")
        return 0 if rows is None else rows.agg(F.max("after")).first()[0] or 0

    def full(self) -> bool:
        return self.nb is not None and self.written() >= self.nb

    def step(self, batch: DataFrame, number: int) -> None:
        states = self.states()
        mine = states.pop(number, None)
        before = max(states.values(), key=lambda s: s["batch"], default=None)
        count = before["after"] if before else 0
        if self.nb is not None and count >= self.nb:
            return
        rows, n = numbered(batch.select("value"))
        after = count + n if self.nb is None else min(count + n, self.nb)
        if after > count:
            stamp = mine["stamp"] if mine else self.spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd-HHmmss")).first()[0]
            self._write(rows, number, count, after, stamp, before)
        rows.unpersist()

    def _write(self, rows: DataFrame, number: int, count: int, after: int, stamp: str, before: dict | None) -> None:
        size = self.max_records or max(after, 1)
        half = count % size if self.max_records else 0  # lines of the open file
        old_stamp = before["open_stamp"] if before and half else stamp
        # the open file keeps its stamp while this batch doesn't fill it
        open_stamp = old_stamp if count // size == after // size else stamp
        state = local_frame(self.spark, [(number, count, after, stamp, open_stamp)], STATE)
        state.write.mode("overwrite").parquet(f"{self.state}/batches/of={number}")
        new = rows.select("value", (F.col("_seq") + count).alias("seq")).filter(F.col("seq") < after)
        if half:
            held = self._rows(f"{self.state}/open/{before['batch']}", "value string, seq long")
            new = new.unionByName(held)
        if self.max_records:
            new = new.withColumn("no", F.expr(f"seq div {size}"))
            if after % size:
                left = new.filter(F.col("no") == after // size).select("value", "seq")
                left.coalesce(1).write.mode("overwrite").parquet(f"{self.state}/open/{number}")
            begun = F.when(F.col("no") == count // size, F.lit(old_stamp)).otherwise(F.lit(stamp))
            placed = new.repartition("no").sortWithinPartitions("no", "seq")
        else:
            begun, placed = F.lit(stamp), new.withColumn("no", F.lit(number))
        name = F.concat(F.lit(f"{self.prefix}_"), begun, F.lit("_"), F.lpad(F.col("no").cast("string"), 6, "0"))
        out = placed.select("value", name.alias("file")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("file").text(self.folder)
        local_frame(self.spark, [(after,)], "after long").write.mode("overwrite").parquet(f"{self.state}/done/of={number}")
