"""Composed jobs: the post preparation chain and the per-state labelled counts.

The chain keeps every row-local step (language, topic flags, state match)
before the one wide step (lexicon sentiment), so filters shrink the token
stream before it is exploded. Filters and row-local features commute, so the
result equals the original order (score, language, zero drop, class, label,
state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.features import add_label, sentiment_classes, topic_flags
from ..operators.filters import drop_zero, keep_lang, keep_located
from ..operators.geo import state_from_text
from ..operators.sentiment import sentiment_carry
from ..operators.stats import group_label_counts


def labelled_posts(posts: DataFrame, states: DataFrame, lexicon: DataFrame, topics: dict,
                   text: str = "full_text", location: str = "user_location", language: str = "en",
                   key: str = "id", sep: str = "_", pick: str = "first",
                   state_alt_cols=("abbr", "code"), state_order: str | None = "ord") -> DataFrame:
    """posts -> language -> topic flags -> state -> located -> sentiment ->
    drop zero -> class -> label."""
    names = list(topics)
    p = keep_lang(posts, language)
    p = topic_flags(p, topics, text_cols=[text], sep=sep)
    p = state_from_text(p, states, location_col=location, state_col="state", pick=pick, key=key,
                        alt_cols=state_alt_cols, order_col=state_order)
    p = keep_located(p, "state")
    # single pass over the (joined) posts: carry only the small columns the
    # later steps and reports need, drop the text after scoring
    carry = [c for c in p.columns if c not in (text, "user_description", "created_at", location, "lang")]
    p = sentiment_carry(p, lexicon, text_cols=[text], carry=carry, sep=sep)
    comp = f"{text}{sep}sentiment{sep}compound"
    p = drop_zero(p, comp)
    p = sentiment_classes(p, [comp], sep=sep)
    p = add_label(p, "label", first=(f"{text}{sep}{names[0]}", "T"), second=(f"{text}{sep}{names[1]}", "B"),
                  class_col=f"{comp}{sep}class")
    return p


def label_counts_by_state(posts: DataFrame, states: DataFrame, lexicon: DataFrame, topics: dict,
                          count_col: str = "user_id", **kw) -> DataFrame:
    p = labelled_posts(posts, states, lexicon, topics, **kw)
    return group_label_counts(p, ("state", "label"), count_col=count_col, out="n")
