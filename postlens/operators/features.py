"""Row-local feature columns: topic flags, sentiment classes, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as K
from ..functions.classes import bucketize, compose_label
from ..functions.text import regex_search
from .projection import require_columns

DEFAULT_TOPICS = {K.TOPIC_A_SUFFIX: K.TOPIC_A_PATTERN, K.TOPIC_B_SUFFIX: K.TOPIC_B_PATTERN}


def topic_flags(df: DataFrame, topics: dict | None = None, text_cols=("full_text", "user-description"),
                case: bool = False, sep: str = "-") -> DataFrame:
    """For each text column and topic, a boolean ``<col><sep><topic>``: regex
    search, case-insensitive unless ``case``; null text gives null."""
    topics = topics or DEFAULT_TOPICS
    require_columns(df, text_cols)
    new = [regex_search(c, pat, case).alias(f"{c}{sep}{name}")
           for c in text_cols for name, pat in topics.items()]
    return df.select("*", *new)


def sentiment_classes(df: DataFrame, compound_cols=("full_text-sentiment-compound",
                                                    "user-description-sentiment-compound"),
                      categories=K.SENTIMENT_CLASSES, suffix: str = "class", sep: str = "-",
                      default: str = K.NO_CLASS, close_last: bool = False) -> DataFrame:
    require_columns(df, compound_cols)
    new = [bucketize(c, categories, default, close_last).alias(f"{c}{sep}{suffix}")
           for c in compound_cols]
    return df.select("*", *new)


def add_label(df: DataFrame, label_col: str = "label",
              first=("full_text-contains_trump", K.LABEL_FIRST),
              second=("full_text-contains_biden", K.LABEL_SECOND),
              neither: str = K.LABEL_NEITHER,
              class_col: str = "full_text-sentiment-compound-class") -> DataFrame:
    """Prefix from two flags (both, first, second, neither) + class text."""
    require_columns(df, [first[0], second[0], class_col])
    lab = compose_label(first[0], second[0], class_col, both=first[1] + second[1], first=first[1],
                        second=second[1], neither=neither)
    return df.withColumn(label_col, lab)
