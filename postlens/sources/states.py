"""State tables: the built-in US list or user tables (WKT geometry)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.geo import us_states_frame
from ..operators.stats import union_all


def us_states(spark: SparkSession) -> DataFrame:
    """``ord, name, abbr, code`` for the fifty states (code: phonetic, see
    ``functions.phonetic``)."""
    return us_states_frame(spark)


def state_dim(frames, columns=("STUSPS10", "NAME10", "geometry")) -> DataFrame:
    """Union per-state (or per-region) tables by name and keep ``columns``."""
    return union_all(frames).select(*columns)


def read_state_tables(spark: SparkSession, paths, fmt: str = "parquet",
                      columns=("STUSPS10", "NAME10", "geometry"), **options) -> DataFrame:
    """Read one or many state tables (parquet/CSV/JSON, geometry as WKT or
    GeoJSON text) in one multi-path read and keep ``columns``."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(list(paths) if not isinstance(paths, str) else paths).select(*columns)
