"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from .errors import CheckpointFolderMissing

# Settings the library depends on for correct results (UTC comparisons, ANSI
# errors on bad input) and for a sane plan (AQE re-planning and skew handling).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "postlens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's required settings.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then follow the data size, not the core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the runtime settings the operators assume (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A session that names none must set one before jobs cut their lineage; a
    machine-local folder would be lost with its machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise CheckpointFolderMissing("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared checkpoint folder, for tables and stream progress."""
    return f"{checkpoint_dir(spark).rstrip('/')}/postlens/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared
    folder named by ``spark.checkpoint.dir``. Later passes read the checkpoint,
    and a lost executor does not force the whole upstream plan to rerun."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
