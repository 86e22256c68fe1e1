"""Keys and types of a capture against the declared paths, in one pass.

``schema_of_variant_agg`` merges the schemas of all records with map-side partial aggregation: the
merged schema, bounded by the number of different keys, is all that reaches the driver. From it come
missing roots, keys that no path declares and types that changed.

A key that is always JSON null has the type VOID and counts as present. A key of several types is a
VARIANT. Records that aren't objects have no keys and are left out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..errors import WrongColumnName
from ..functions.text import col_of
from ..sources.files import local_frame

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def merged_schema(df: DataFrame, raw: str = "raw") -> StructType:
    """The merged schema of the records' objects (no fields if there is none)."""
    v = col_of(raw)
    told = df.agg(F.schema_of_variant_agg(F.when(F.schema_of_variant(v).startswith("OBJECT"), v))).first()[0]
    if not told or not told.startswith("OBJECT<"):
        return StructType()
    text = re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", re.sub(r"(^|: |<)OBJECT<>", r"\1VARIANT", told))
    return _parsed(df.sparkSession, text)


def _parsed(spark: SparkSession, text: str) -> StructType:
    return spark.createDataFrame([], f"s {text}").schema["s"].dataType


def _leaves(kind: DataType, path=()) -> dict[tuple, DataType]:
    if isinstance(kind, StructType) and kind.fields:
        return {p: t for f in kind for p, t in _leaves(f.dataType, (*path, f.name)).items()}
    return {path: kind}


def _at(kind: DataType, path) -> DataType | None:
    for key in path:
        if not isinstance(kind, StructType) or key not in kind.names:
            return None
        kind = kind[key].dataType
    return kind


def _fits(declared: str, found: str) -> bool:
    """Whether a declared type reads every value of the found one: the same kind of value, or any."""
    a, b = (re.split(r"[(<]", x.lower())[0] for x in (declared, found))
    return a == b or b == "void" or a == "variant" or a in NUMBERS and b in NUMBERS or a == "string" and b in ("timestamp", "date")


def drift(df: DataFrame, paths, raw: str = "raw", roots=(), sep: str = "-") -> DataFrame:
    """``(path, declared, found, drift)``, one row a path that differs: ``missing`` (no record has it),
    ``new`` (not declared) or ``changed`` (another type). ``roots``: further declared root keys."""
    whole = merged_schema(df, raw)
    declared = {tuple(p): t for p, t in paths} | {(r,): None for r in roots if r}
    rows = []
    for path, kind in declared.items():
        found = _at(whole, path)
        if found is None:
            rows.append((sep.join(path), kind, None, "missing"))
        elif kind and not _fits(kind, found.simpleString()):
            rows.append((sep.join(path), kind, found.simpleString(), "changed"))
    for path, kind in _leaves(whole).items():
        if path and not any(path[: len(p)] == p for p in declared):
            rows.append((sep.join(path), None, kind.simpleString(), "new"))
    return local_frame(df.sparkSession, sorted(rows, key=str), "path string, declared string, found string, drift string")


def require_root_keys(df: DataFrame, roots, raw: str = "raw") -> None:
    """Raise ``WrongColumnName`` for the root keys that occur in no record, by one pass for any number."""
    roots = list(dict.fromkeys(r for r in roots if r))
    if not roots:
        return
    have = set(merged_schema(df, raw).names)
    missing = [r for r in roots if r not in have]
    if missing:
        raise WrongColumnName(missing)
