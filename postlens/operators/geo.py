"""Location text to state.

* ``state_from_text`` / ``state_matches``: the state list is a small checked
  dimension folded into one narrow projection of literal regexes (no join,
  no shuffle): ``filter(array(when(loc rlike p_i, name_i) ...), x -> x is not null)``.
* ``state_matches_join``: the same matches, one row per match (the match
  array exploded; no join of posts with states).
* ``gazetteer_state``: word n-grams of the location, equi-joined with a
  user-supplied gazetteer ``(city, state, lat, lon)``; Spark broadcasts the
  gazetteer by its byte threshold, else plans a shuffle join.
* ``state_from_address``: state part of a geocoder-style address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.geo import address_state, pick_one, state_match_array, state_pattern
from ..functions.phonetic import metaphone
from ..functions.text import col_of
from ..sources.files import local_frame
from .projection import require_columns
from .sentiment import on_first, repeated, row_hash, row_of


def us_states_frame(spark) -> DataFrame:
    """Default state table: name, abbr, phonetic code, list order."""
    rows = [(i, n, a, metaphone(n)) for i, (n, a) in enumerate(K.US_STATES)]
    return local_frame(spark, rows, "ord int, name string, abbr string, code string")


def state_patterns(states: DataFrame, name_col: str = "name", alt_cols=("abbr", "code"),
                   order_col: str | None = "ord", word_boundary: bool = False):
    """``[(name, pattern)]`` from the state table (a list that becomes literals of the plan)."""
    alt_cols = [c for c in alt_cols if c in states.columns]
    sel = states.select(col_of(name_col).alias("_n"), *[col_of(c).alias(f"_a{i}") for i, c in enumerate(alt_cols)],
                        *( [col_of(order_col).alias("_o")] if order_col else []))
    if order_col:
        sel = sel.orderBy("_o", "_n")
    rows = sel.collect()
    out = []
    for r in rows:
        alts = [r["_n"]] + [r[f"_a{i}"] for i in range(len(alt_cols))]
        out.append((r["_n"], state_pattern(alts, word_boundary=word_boundary)))
    return out


def state_matches(df: DataFrame, states: DataFrame, location_col: str = "user-location",
                  matches_col: str = "state_matches", **pattern_opts) -> DataFrame:
    """Add the array of every matching state (list order); null location gives null."""
    require_columns(df, [location_col])
    pats = state_patterns(states, **pattern_opts)
    return df.withColumn(matches_col, state_match_array(location_col, pats))


def state_from_text(df: DataFrame, states: DataFrame, location_col: str = "user-location",
                    state_col: str = "state", pick: str = "first", key: str = "id", seed: int = 0,
                    **pattern_opts) -> DataFrame:
    """One state per row from the matches: ``first`` (list order), ``hash``
    (seeded by key) or ``longest``. No match, null or empty location: null."""
    require_columns(df, [location_col])
    pats = state_patterns(states, **pattern_opts)
    arr = state_match_array(location_col, pats)
    return df.withColumn(state_col, pick_one(arr, pick, key if pick == "hash" else None, seed))


def state_matches_join(df: DataFrame, states: DataFrame, location_col: str = "user-location",
                       state_col: str = "state", how: str = "inner", **pattern_opts) -> DataFrame:
    """One row per match (``how="inner"``), or also one with a null state without any (``"left"``);
    ``_ord`` is the state's place in the list."""
    require_columns(df, [location_col])
    pats = state_patterns(states, **pattern_opts)
    explode = {"inner": F.explode, "left": F.explode_outer}[how]
    rows = df.select("*", explode(state_match_array(location_col, pats, places=True)).alias("_match"))
    return rows.withColumns({state_col: F.col("_match.name"), "_ord": F.col("_match.place")}).drop("_match")


def _word_ngrams(loc, max_n: int):
    words = F.filter(F.split(F.coalesce(loc, F.lit("")), r"[\s,;/|]+"), lambda w: w != F.lit(""))
    size = F.size(words)
    return F.flatten(F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max_n), F.greatest(size, F.lit(1)))),
        lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))),
            lambda i: F.struct(i.alias("pos"), n.alias("n"),
                               F.array_join(F.slice(words, i, n), " ").alias("gram")))))


def gazetteer_state(df: DataFrame, gazetteer: DataFrame, location_col: str = "user-location",
                    state_col: str = "state2", coord_col: str = "coord", key: str = "id",
                    pick: str = "first", seed: int = 0, max_words: int | None = None) -> DataFrame:
    """Place names found in the location, looked up to (state, lat, lon).

    Candidates are word n-grams, up to the words of the gazetteer's longest
    name, matched exactly against ``gazetteer.city``. ``first`` keeps the
    earliest (then longest) candidate; ``hash`` a seeded choice by key. Rows
    without a hit get null state and null coordinates. A hit whose state is
    null keeps its coordinates. The input is evaluated once; rows are grouped
    by the hash of their content and their columns go with the first n-gram
    only (see ``sentiment``), so ids may repeat or be null.
    """
    require_columns(df, [location_col, key])
    place = F.struct(F.col("state").alias("_st"), F.col("lat").cast("double").alias("_lat"),
                     F.col("lon").cast("double").alias("_lon"))
    gz = gazetteer.groupBy(F.col("city").alias("_gram")).agg(F.min(place).alias("_place"))
    if max_words is None:
        words = F.size(F.split(F.col("city"), r"[\s,;/|]+"))
        max_words = gazetteer.agg(F.max(words)).first()[0] or 1
    base = df.select(row_hash(df, df.columns).alias("_key"), row_of(df.columns).alias("_all"), col_of(location_col).alias("_loc"), col_of(key).alias("_id"))
    found = F.when(F.col("_loc").isNotNull() & (F.col("_loc") != F.lit("")), _word_ngrams(F.col("_loc"), max_words))
    grams = base.select("_key", "_all", "_id", F.posexplode_outer(found).alias("_at", "_g"))
    grams = grams.select("_key", *on_first("_at", "_all"), "_id", F.col("_g.pos").alias("_pos"),
                         F.col("_g.n").alias("_words"), F.col("_g.gram").alias("_gram"))
    hits = grams.join(gz, "_gram", "left").filter(F.col("_place").isNotNull() | F.col("_first"))
    if pick == "first":
        order = F.struct(F.col("_pos"), (-F.col("_words")).alias("_nn"), F.col("_place"))
    elif pick == "hash":
        order = F.struct(F.xxhash64(F.col("_id"), F.col("_pos"), F.col("_words"), F.lit(seed)).alias("_h"), F.col("_place"))
    else:
        raise ValueError(pick)
    order = F.when(F.col("_place").isNotNull(), order)
    best = hits.groupBy("_key").agg(F.min(order).alias("_best"), F.count_if("_first").alias("_n"), F.first("_row", ignorenulls=True).alias("_row"))
    coord = F.when(F.col("_best").isNotNull(),
                   F.struct(F.col("_best._place._lat").alias("lat"), F.col("_best._place._lon").alias("lon")))
    return repeated(best, "_n").select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(df.columns)],
                                       F.col("_best._place._st").alias(state_col), coord.alias(coord_col))


def state_from_address(df: DataFrame, address_col: str = "address", state_col: str = "state") -> DataFrame:
    require_columns(df, [address_col])
    return df.withColumn(state_col, address_state(address_col))
