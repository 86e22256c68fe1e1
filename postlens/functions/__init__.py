"""Column-level building blocks (each returns a ``Column``)."""

from .classes import bucketize, compose_label, label_prefix
from .geo import address_state, pick_one, state_match_array, state_pattern
from .text import (col_of, first_non_null, keyword_match, keyword_pattern, regex_search,
                   tokens)
from .time import bound_literal, parse_post_time

__all__ = [
    "bucketize", "compose_label", "label_prefix", "address_state", "pick_one",
    "state_match_array", "state_pattern", "col_of", "first_non_null", "keyword_match",
    "keyword_pattern", "regex_search", "tokens", "bound_literal", "parse_post_time",
]
