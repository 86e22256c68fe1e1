"""Projection and schema operators: JSON flatten, text priority, drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from .. import constants as K
from ..errors import WrongColumnName
from ..functions.text import col_of, first_non_null
from ..functions.time import parse_post_time
from .drift import require_root_keys


def require_columns(df: DataFrame, columns) -> None:
    """Raise ``WrongColumnName`` naming every absent column (driver-side)."""
    have = set(df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise WrongColumnName(missing)


def _json_path(path) -> str:
    return "$" + "".join("['" + p.replace("'", "\\'") + "']" for p in path)


def flatten(df: DataFrame, paths=K.PATHS_SHORT, raw: str = "raw", index: str | None = "id",
            date: str | None = "created_at", sep: str = "-", validate: bool = True,
            index_type: str = "bigint") -> DataFrame:
    """One column per JSON path, named by joining the path with ``sep``.

    A missing key or a non-object on the way gives null. ``date`` (and
    ``user<sep>created_at`` when selected) is parsed to a timestamp; ``index``
    becomes the first column. ``index=None`` / ``date=None`` opt out.
    ``validate`` costs one aggregate pass over the input; skip it when the
    capture schema is known.
    """
    paths = [(tuple(p), t) for p, t in paths]
    if validate:
        require_root_keys(df, [index, date] + [p[0] for p, _ in paths], raw)
    v = F.col(raw)
    cols = []
    if index:
        cols.append(F.try_variant_get(v, _json_path([index]), index_type).alias(index))
    if date:
        cols.append(parse_post_time(F.try_variant_get(v, _json_path([date]), "string")).alias(date))
    for path, typ in paths:
        name = sep.join(path)
        got = F.try_variant_get(v, _json_path(path), typ)
        if path == ("user", "created_at"):
            got = parse_post_time(got)
        cols.append(got.alias(name))
    return df.select(*cols)


def first_text(df: DataFrame, new_col: str = "full_text", text_cols=K.TEXT_PRIORITY,
               drop: bool = True) -> DataFrame:
    """First non-null text in priority order; optionally drop the sources."""
    require_columns(df, text_cols)
    out = df.withColumn(new_col, first_non_null(*text_cols))
    if drop:
        out = out.drop(*[c for c in text_cols if c != new_col])
    return out


def drop_columns(df: DataFrame, columns) -> DataFrame:
    require_columns(df, columns)
    return df.drop(*columns)


def numeric_columns(df: DataFrame, drop=("user-id",), exclude_null_booleans: bool = True) -> list[str]:
    """Numeric and boolean columns minus ``drop``.

    Boolean columns that hold a null are left out (one aggregate pass), as a
    flag with a missing value is not a usable numeric feature.
    """
    drop = set(drop or ())
    fields = [f for f in df.schema.fields
              if f.name not in drop and isinstance(f.dataType, (NumericType, BooleanType))]
    bools = [f.name for f in fields if isinstance(f.dataType, BooleanType) and f.nullable]
    skip = set()
    if exclude_null_booleans and bools:
        row = df.agg(*[F.max(col_of(b).isNull().cast("int")).alias(f"b{i}")
                       for i, b in enumerate(bools)]).first()
        skip = {b for i, b in enumerate(bools) if row[f"b{i}"]}
    return [f.name for f in fields if f.name not in skip]


def select_preview(df: DataFrame, columns=None, n: int = 5, order_by: str = "id") -> DataFrame:
    """First ``n`` rows by ``order_by`` (a top-n, so deterministic)."""
    out = df.select(*[col_of(c) for c in columns]) if columns else df
    return out.orderBy(col_of(order_by)).limit(n)
