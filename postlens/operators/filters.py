"""Row filters. All are narrow (no shuffle) and run unchanged on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of, keyword_match
from ..functions.time import bound_literal


def between_times(df: DataFrame, start, end, col: str = "created_at") -> DataFrame:
    """Strictly after ``start`` and strictly before ``end`` (bounds may carry
    a UTC offset). Literal bounds reach the Parquet scan as pushed filters."""
    typ = df.schema[col].dataType
    c = col_of(col)
    return df.filter((c > bound_literal(start, typ)) & (c < bound_literal(end, typ)))


def drop_zero(df: DataFrame, col: str = "full_text-sentiment-compound") -> DataFrame:
    """Drop rows equal to 0; rows with a null value are kept."""
    return df.filter(~col_of(col).eqNullSafe(F.lit(0)))


def keep_lang(df: DataFrame, language: str = "en", col: str = "lang") -> DataFrame:
    return df.filter(col_of(col) == F.lit(language))


def keep_located(df: DataFrame, col: str = "state") -> DataFrame:
    return df.filter(col_of(col).isNotNull())


def topic_subset(df: DataFrame, a: str, b: str, which: str = "a_only") -> DataFrame:
    """``a and not b`` (``a_only``) or ``b and not a`` (``b_only``)."""
    ca, cb = col_of(a), col_of(b)
    if which == "a_only":
        return df.filter(ca & ~cb)
    if which == "b_only":
        return df.filter(~ca & cb)
    raise ValueError(which)


def exclude_values(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose value is in ``values``; null values are kept."""
    c = col_of(col)
    return df.filter(~F.coalesce(c.isin(list(values)), F.lit(False)))


def track_keywords(df: DataFrame, words, cols=("full_text",)) -> DataFrame:
    """Keep rows where any text column holds a tracked word (case-insensitive,
    whole word). An empty word list keeps nothing."""
    cond = None
    for c in cols:
        m = F.coalesce(keyword_match(c, words), F.lit(False))
        cond = m if cond is None else (cond | m)
    return df.filter(cond)
