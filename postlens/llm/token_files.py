"""Token-id files: flat unsigned integers, 64-bit document offsets, read by memory map.

A data set is a folder of shards in document order. Shard n has ``n.bin`` (the ids, little-endian
unsigned 16-bit integers if the vocabulary fits, else 32-bit), ``n.off`` (64-bit offsets of its
documents in ``n.bin``, one more than documents) and ``n.doc`` (64-bit document ids). The table
``manifest`` has a row for each shard; a shard's base, the ids before it, is the prefix sum of the
shards' sizes.

One range shuffle of the texts by id puts documents in order; encoding streams into the files, so
a task holds one slice of texts. Shards are written under a temporary name and renamed, and their
content is determined by the rows, so a task that runs again after an executor is lost leaves the
same files.

Defined cases: a null or empty text has only the end id; equal ids are ordered by their text;
null ids come first; an empty table makes no shards and reads back empty; extra columns are not
read.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunk_tokens import encoder
from .store import map_columns, sliced

#: Characters of texts whose words are told apart at once, and words kept by a Python worker (about 120 MB).
SLICE_CHARS = 4_000_000
KEPT_WORDS = 300_000
NO_ID = -(1 << 63)


def vocabulary_type(path: str) -> str:
    """The smallest of the two file types that holds every id of the tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])], default=0)
    return "<u2" if most < 1 << 16 else "<u4"


def file_system(uri: str):
    """The Arrow file system of a shared folder and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.removeprefix("file:") if uri.startswith("file:") else os.path.abspath(uri))


def write_tokens(docs: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes ``docs`` into the folder ``out`` (a URI that driver and executors share) and returns
    the manifest: (shard, n_docs, n_tokens, dtype)."""
    spark = docs.sparkSession
    dtype = vocabulary_type(path)

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encode = encoder(path, False, dtype, KEPT_WORDS).encode_many
        offsets, ids, sink = [0], [], None
        system, folder = file_system(out)
        name, tmp = f"{folder}/{shard:06d}", f"{folder}/.{shard:06d}-{uuid.uuid4().hex}"
        for batch in sliced(batches, "text", SLICE_CHARS):
            if sink is None:
                system.create_dir(folder, recursive=True)
                sink = system.open_output_stream(f"{tmp}.bin")
            made, at = encode([text or "" for text in batch["text"]])
            sink.write(np.insert(made, at[1:], end_id).tobytes())  # the end id behind each text
            offsets += (offsets[-1] + at[1:] + np.arange(1, len(at))).tolist()
            ids += [NO_ID if doc is None else doc for doc in batch["id"]]
        if sink is None:
            return
        sink.close()
        for ending, values in (("off", offsets), ("doc", ids)):
            with system.open_output_stream(f"{tmp}.{ending}") as f:
                f.write(np.array(values, "<i8").tobytes())
        for ending in ("bin", "off", "doc"):
            system.move(f"{tmp}.{ending}", f"{name}.{ending}")
        yield {"shard": [shard], "n_docs": [len(ids)], "n_tokens": [offsets[-1]], "dtype": [dtype]}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # a text's first letters are the second key, so rows of one id (or of none) spread over shards
    ordered = rows.repartitionByRange("id", F.substring("text", 1, 64)).sortWithinPartitions("id", "text")
    map_columns(ordered, run, "shard long, n_docs long, n_tokens long, dtype string").write.mode("overwrite").parquet(f"{out}/manifest")
    return spark.read.parquet(f"{out}/manifest")


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """One row per document of the folder ``out``: (doc_id, start, n_tokens, ids), where ``start`` is
    the number of ids before it and ``ids`` are little-endian unsigned 32-bit integers."""
    manifest = spark.read.parquet(f"{out}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard only
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, manifest.count())

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        system, folder = file_system(out)

        def values(name: str, dtype: str) -> np.ndarray:
            if system.type_name == "local":
                return np.memmap(f"{folder}/{name}", dtype, "r")
            with system.open_input_file(f"{folder}/{name}") as f:
                return np.frombuffer(f.read_buffer(), dtype)

        for batch in batches:
            for shard, dtype, base in zip(batch["shard"], batch["dtype"], batch["base"], strict=True):
                offsets, ids = values(f"{shard:06d}.off", "<i8"), values(f"{shard:06d}.doc", "<i8")
                tokens = values(f"{shard:06d}.bin", dtype)
                for a in range(0, len(ids), 1000):
                    at = offsets[a : a + 1001]
                    yield {
                        "doc_id": [None if i == NO_ID else int(i) for i in ids[a : a + 1000]],
                        "start": (base + at[:-1]).tolist(),
                        "n_tokens": np.diff(at).tolist(),
                        "ids": [tokens[x:y].astype("<u4").tobytes() for x, y in zip(at, at[1:], strict=False)],
                    }

    return map_columns(based.repartition(n), run, "doc_id long, start long, n_tokens long, ids binary")
