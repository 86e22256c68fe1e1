"""Helpers shared by the operators: tables in the shared folder and Arrow batch mapping."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named by ``spark.checkpoint.dir``.

    Only a session without that setting (local tests) gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="postlens-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has used."""
    return f"{shared_dir(spark)}/postlens-llm/{name}-{uuid.uuid4().hex}"


#: Tables of up to so many bytes as Parquet are broadcast, whatever the session's threshold; larger
#: ones are left to Spark's planner, which shuffles.
BROADCAST_BYTES = 4 << 20


def bytes_at(spark: SparkSession, path: str) -> int:
    """The bytes of the files below ``path``, by Spark's own file system layer."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def written_side(df: DataFrame, name: str, hashed: bool = False) -> DataFrame:
    """``written`` for the smaller side of a join: to be broadcast if its measured size is within
    ``BROADCAST_BYTES``, so that the other side, texts for instance, needs no shuffle. ``hashed``: if it
    is larger, a partition of it is hashed, so that the other side is shuffled but not sorted."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    if bytes_at(df.sparkSession, path) <= BROADCAST_BYTES:
        return F.broadcast(made)
    return made.hint("shuffle_hash") if hashed else made


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts the lineage: later reads take the table, also after an executor is lost. The table
    stays until the folder is cleared, since the returned frame is lazy.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_columns(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]], schema: str) -> DataFrame:
    """``df.mapInArrow`` over plain column lists: ``fn`` maps an iterator of ``{column: values}``
    to an iterator of ``{column: values}`` with the columns of ``schema``; values may be Arrow arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def column(values, to: pa.DataType) -> pa.Array:
        return values.cast(to) if isinstance(values, pa.Array) else pa.array(values, type=to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)} for batch in batches)
        for made in fn(columns):
            yield pa.RecordBatch.from_arrays([column(made[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def appended(df: DataFrame, text_col: str, fn: Callable[[list], dict[str, list]], added: str, budget: int) -> DataFrame:
    """``df`` with its columns renamed to c0, c1, ... (so that no name clashes) and the columns
    ``added``, which ``fn`` makes from the values of ``text_col``. Other columns pass through as Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    at = df.columns.index(text_col)
    new = _parse_datatype_string(added)
    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)] + list(new))
    types = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin = batch.column(at).to_pylist(), 0
            for piece in sliced(iter([{"text": texts}]), "text", budget):
                n = len(piece["text"])
                made = fn(piece["text"])
                arrays = [*batch.slice(begin, n).columns, *(pa.array(made[f.name], type=f.type) for f in types)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])
                begin += n

    return df.toDF(*schema.names[: len(df.columns)]).mapInArrow(run, schema)


def sliced(batches: Iterator[dict[str, list]], column: str, budget: int) -> Iterator[dict[str, list]]:
    """Cuts batches so that the texts of ``column`` in one slice have about ``budget`` characters
    at most; a single longer text makes a slice alone."""
    for batch in batches:
        start, held = 0, 0
        texts = batch[column]
        for i, text in enumerate(texts):
            n = len(text or ())
            if i > start and held + n > budget:
                yield {k: v[start:i] for k, v in batch.items()}
                start, held = i, 0
            held += n
        if texts:
            yield {k: v[start:] for k, v in batch.items()}
