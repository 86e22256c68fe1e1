"""Small driver-side tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small driver-side table (lexicon, state list, SSE curve) as a frame.

    Goes through pandas + Arrow, so the rows land in the JVM directly and no
    Python worker is started to read them back.
    """
    import pandas as pd
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    pdf = pd.DataFrame([tuple(r) for r in rows], columns=[f.name for f in st.fields])
    if pdf.empty:
        return spark.createDataFrame([], st)
    return spark.createDataFrame(pdf, schema=st)


def spread(scan: DataFrame) -> DataFrame:
    """A scan that has fewer splits than there are cores (a small single file) over all cores; any other
    as it is. For scans only: asking a joined frame for its partitions would run its stages."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
