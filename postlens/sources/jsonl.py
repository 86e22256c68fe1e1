"""JSON Lines captures: file listing, parsing to VARIANT, file sampling.

Raw records stay VARIANT (``parse_json``) until ``flatten`` projects typed
columns: an always-null or wrong-typed object then gives null instead of an
analysis error, and a malformed line fails the job (ANSI), as ``json.loads``
would. Blank lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_paths(folder: str) -> str:
    """Glob of the ``.json`` files directly in ``folder`` (not recursive).

    Like the original plain string concatenation, a folder given without a
    trailing separator acts as a file-name prefix.
    """
    return folder + "*.json"


def parse_lines(lines: DataFrame, col: str = "value", out: str = "raw") -> DataFrame:
    """Drop blank lines, parse the rest to VARIANT (malformed lines raise).

    The filter is on the raw string, so the parse stands only in the projection
    and runs once a line. The test inside guards the parser itself: Catalyst may
    evaluate later filters on parsed fields first.
    """
    v = F.col(col)
    held = F.trim(v) != F.lit("")
    return lines.filter(held).select(F.parse_json(F.when(held, v)).alias(out))


def read_posts(spark: SparkSession, path_list=None, folder: str | None = None) -> DataFrame:
    """Read JSON Lines files to a frame with one VARIANT column ``raw``.

    ``path_list`` wins over ``folder``; one of them is required, and a path
    list must be a non-empty list of strings.
    """
    if folder is not None and not isinstance(folder, str):
        raise TypeError(f"folder: expected str, got {type(folder).__name__}")
    if path_list is None:
        if folder is None:
            raise ValueError("nothing to read: give path_list or folder")
    elif not isinstance(path_list, list) or any(not isinstance(p, str) for p in path_list):
        raise TypeError("path_list: expected a list of str")
    elif not path_list:
        raise ValueError("path_list is empty")
    paths = path_list if path_list is not None else [json_paths(folder)]
    return parse_lines(spark.read.text(paths))


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """File listing (path, modificationTime, length) without reading contents."""
    return (spark.read.format("binaryFile").load(pattern)
            .select("path", "modificationTime", "length"))


def sample_files(spark: SparkSession, pattern: str, fraction_den: int = 3, seed: int = 0) -> list[str]:
    """A seeded third (``n div 3``) of the matching files, chosen by a hash
    of the path, for feeding ``read_posts(path_list=...)``."""
    files = list_files(spark, pattern)
    k = files.count() // fraction_den
    chosen = files.orderBy(F.xxhash64(F.col("path"), F.lit(seed)), F.col("path")).limit(k).select("path")
    return [r["path"] for r in chosen.collect()]


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """The most recently modified matching file (ties: greatest path)."""
    files = list_files(spark, pattern)
    r = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return r["p"] if r else None
