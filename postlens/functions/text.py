"""Column expressions over text: priority pick, regex tests, tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import WordTypeError

# Token rule for lexicon scoring: lower-case, split on anything outside a-z.
TOKEN_SPLIT = "[^a-z]+"
# A keyword matches when no letter, digit or underscore touches it.
_WORD_EDGE = r"[\p{L}\p{N}_]"


def col_of(c) -> Column:
    return c if isinstance(c, Column) else F.col(f"`{c}`")


def first_non_null(*cols) -> Column:
    """First non-null value in priority order (an empty string counts)."""
    return F.coalesce(*[col_of(c) for c in cols])


def regex_search(c, pattern: str, case: bool = False) -> Column:
    """Regex *search* (not full match); null in gives null out.

    ``case=False`` is Unicode-aware case folding, as in Python's ``re``.
    """
    flags = "" if case else "(?iu)"
    return col_of(c).rlike(flags + pattern)


def check_words(words) -> list[str]:
    bad = [w for w in words if not isinstance(w, str)]
    if bad:
        raise WordTypeError(bad)
    return list(words)


def keyword_pattern(words) -> str | None:
    """Case-insensitive whole-word alternation for tracked keywords.

    Returns None for an empty list (which matches nothing).
    """
    words = check_words(words)
    if not words:
        return None
    alt = "|".join(re.escape(w) for w in words)
    return f"(?iu)(?<!{_WORD_EDGE})(?:{alt})(?!{_WORD_EDGE})"


def keyword_match(c, words) -> Column:
    pat = keyword_pattern(words)
    if pat is None:
        return F.lit(False)
    return col_of(c).rlike(pat)


def tokens(c) -> Column:
    """Lower-cased a-z word tokens of a text; null text gives an empty array."""
    parts = F.split(F.lower(F.coalesce(col_of(c), F.lit(""))), TOKEN_SPLIT)
    return F.filter(parts, lambda t: t != F.lit(""))
