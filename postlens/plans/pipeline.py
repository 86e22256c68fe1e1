"""The two end-to-end chains with the original column names.

``prepare_posts``: JSON Lines captures -> flattened, scored, classed,
labelled and located posts (one lazy plan; the only wide step is the
lexicon sentiment).

``cluster_and_map``: two k-means models (features chosen by type with the
elbow for k, then four chosen features with k = 6), then the per-state
tables behind the maps: majority label per state, compound statistics,
histogram artefact paths and the map feed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import cluster as C
from ..operators import features as FE
from ..operators import filters as FL
from ..operators import geo as G
from ..operators import projection as P
from ..operators import stats as S
from ..operators.sentiment import sentiment
from ..operators.sentiment_rules import sentiment_rules
from ..session import materialize
from ..sinks import feeds
from ..sources.jsonl import read_posts

NARROW_FEATURES = ["full_text-contains_trump", "full_text-contains_biden", "full_text-sentiment-compound",
                   "user-description-sentiment-compound"]


def prepare_posts(spark: SparkSession, lexicon: DataFrame, states: DataFrame | None = None, path_list=None,
                  folder: str | None = None, paths=K.PATHS_SHORT, language: str = "en", topics: dict | None = None,
                  pick: str = "first", validate: bool = True, scorer: str = "rules",
                  boosters: DataFrame | None = None, negations: DataFrame | None = None, idioms: DataFrame | None = None,
                  flat: DataFrame | None = None) -> DataFrame:
    """``scorer``: ``rules`` (context rules, with optional booster, negation and idiom tables) or ``plain``.
    The captures are scanned and parsed once; ``validate`` costs one more pass over the keys. ``flat``:
    posts flattened before, such as a time range of the store by day, in place of captures."""
    if flat is None:
        flat = P.flatten(read_posts(spark, path_list=path_list, folder=folder), paths, validate=validate)
    df = flat
    df = P.first_text(df, "full_text", K.TEXT_PRIORITY, drop=True)
    df = FE.topic_flags(df, topics, text_cols=["full_text", "user-description"])
    df = FL.keep_lang(df, language)
    states = states if states is not None else G.us_states_frame(spark)
    df = G.state_from_text(df, states, "user-location", "state", pick=pick)
    df = FL.keep_located(df, "state")
    texts = ["full_text", "user-description"]
    if scorer == "rules":
        df = sentiment_rules(df, lexicon, boosters, negations, texts, idioms=idioms)
    elif scorer == "plain":
        df = sentiment(df, lexicon, texts)
    else:
        raise ValueError(f"unknown scorer {scorer!r}")
    df = FL.drop_zero(df, "full_text-sentiment-compound")
    df = FE.sentiment_classes(df)
    return FE.add_label(df)


def cluster_and_map(posts: DataFrame, states: DataFrame, n_init: int = 10, max_iter: int = 300,
                    max_cluster: int = 10, seeds=(20, 30), states_key: str = "name",
                    hist_path: str = "image/hist", wide_k: int | None = None,
                    checkpoint: bool = True) -> dict[str, DataFrame]:
    """``wide_k=None`` picks k for the wide model by the elbow of the SSE sweep.

    The prepared posts are read by many passes (feature statistics, k-means
    sweeps, per-state tables); with ``checkpoint`` they are written once to
    the shared checkpoint folder and every pass reads that copy.
    """
    if checkpoint:
        posts = materialize(posts)
    wide = C.km(posts, cols=None, n_cluster=wide_k, drop=("user-id",), max_cluster=max_cluster, n_init=n_init,
                max_iter=max_iter, seed=seeds[0], key="id", out="kmlabel_opt")
    both = C.km(wide, cols=NARROW_FEATURES, n_cluster=6, n_init=n_init, max_iter=max_iter, seed=seeds[1],
                key="id", out="kmlabel")
    out = {"posts": both}
    table = states
    for label in ("label", "kmlabel"):
        table = S.join_states(table, S.majority_label(both, label, "state", "user-id", f"cluster_max_{label}"),
                              states_key, "state")
        table = feeds.state_histogram_paths(table, both, label=label, path=hist_path, states_key=states_key,
                                            state_col="state")
    table = S.join_states(table, S.describe_by(both, "state", "full_text-sentiment-compound",
                                               ("count", "mean", "std")), states_key, "state")
    out["states"] = table
    out["cluster_label_counts"] = S.group_label_counts(both, ("kmlabel", "label"), "user-id", "count")
    out["feed_kmlabel"] = feeds.map_feed_columns(table, "cluster_max_kmlabel")
    return out
