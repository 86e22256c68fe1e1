"""Sentiment classes and combined labels as plain CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import col_of


def bucketize(c, categories=K.SENTIMENT_CLASSES, default: str = K.NO_CLASS,
              close_last: bool = False) -> Column:
    """Name of the first interval ``[lo, hi)`` holding the value.

    Null, out-of-range values and (unless ``close_last``) the top edge get
    ``default``.
    """
    x = col_of(c)
    expr = None
    last = len(categories) - 1
    for i, (name, lo, hi) in enumerate(categories):
        upper = (x <= F.lit(float(hi))) if (close_last and i == last) else (x < F.lit(float(hi)))
        cond = (x >= F.lit(float(lo))) & upper
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def label_prefix(a, b, both: str = K.LABEL_BOTH, first: str = K.LABEL_FIRST,
                 second: str = K.LABEL_SECOND, neither: str = K.LABEL_NEITHER) -> Column:
    """Prefix from two flags; a null flag gives null."""
    a, b = col_of(a), col_of(b)
    return (F.when(a & b, F.lit(both))
            .when(a & ~b, F.lit(first))
            .when(~a & b, F.lit(second))
            .when(~a & ~b, F.lit(neither)))


def compose_label(a, b, cls, **prefixes) -> Column:
    return F.concat(label_prefix(a, b, **prefixes), col_of(cls))
