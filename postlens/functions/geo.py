"""Location text to US state: match arrays, pick policies, address parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

ADDRESS_STATE = ", .*, (.*), United States"


def state_pattern(alternatives, escape: bool = True, word_boundary: bool = False) -> str:
    """Case-sensitive search pattern ``(name|abbr|code)`` for one state."""
    alts = [a for a in alternatives if a]
    body = "|".join(re.escape(a) if escape else a for a in alts)
    if word_boundary:
        return rf"(?<![\p{{L}}\p{{N}}_])({body})(?![\p{{L}}\p{{N}}_])"
    return f"({body})"


def state_match_array(loc, states, places: bool = False) -> Column:
    """All states whose pattern occurs in ``loc``, in list order.

    ``states`` is a list of ``(name, pattern)``. A null or empty location gives
    null (no match array at all). Patterns are literals, compiled once per task.
    ``places``: structs (name, place in the list) instead of names.
    """
    loc = col_of(loc)
    told = [F.struct(F.lit(n).alias("name"), F.lit(i).alias("place")) if places else F.lit(n) for i, (n, _) in enumerate(states)]
    arr = F.array(*[F.when(loc.rlike(p), t) for t, (_, p) in zip(told, states, strict=True)])
    matches = F.filter(arr, lambda x: x.isNotNull())
    return F.when(loc.isNotNull() & (loc != F.lit("")), matches)


def pick_one(arr, policy: str = "first", key=None, seed: int = 0) -> Column:
    """Choose one element: ``first`` (list order), ``hash`` (seeded, by key)
    or ``longest`` (longest name, then list order). Empty arrays give null."""
    a = col_of(arr)
    n = F.size(a)
    if policy == "first":
        chosen = F.get(a, F.lit(0))
    elif policy == "hash":
        if key is None:
            raise ValueError("policy 'hash' needs a key column")
        idx = F.pmod(F.xxhash64(col_of(key), F.lit(seed)), F.greatest(n, F.lit(1)).cast("long"))
        chosen = F.get(a, idx.cast("int"))
    elif policy == "longest":
        ranked = F.transform(a, lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("v")))
        chosen = F.array_min(ranked)["v"]
    else:
        raise ValueError(f"unknown pick policy {policy!r}")
    return F.when(n > 0, chosen)


def address_state(addr) -> Column:
    """State part of ``"..., <county>, <state>, United States"``; null if absent."""
    return F.nullif(F.regexp_extract(col_of(addr), ADDRESS_STATE, 1), F.lit(""))
