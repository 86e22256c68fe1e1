"""Named jobs over the stand-in tables (one per catalogue entry).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names carry no ``-`` and match the DuckDB twin in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster as C
from ..operators import features as FE
from ..operators import filters as FL
from ..operators import geo as G
from ..operators import projection as P
from ..operators import stats as S
from ..operators.sentiment import sentiment
from ..session import fresh_folder
from ..sources import testbed as tb
from ..streaming import capture as CAP
from .prepare import label_counts_by_state, labelled_posts

HIST_PATH = "image/hist"


LABEL_COLUMNS = ("id", "lang", "full_text", "user_id", "user_location")


def _labelled(spark, sf):
    return labelled_posts(tb.posts(spark, sf, LABEL_COLUMNS), tb.states(spark, sf), tb.lexicon(spark), tb.TOPICS)


# -- flagship ---------------------------------------------------------------
def q_label_counts_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return label_counts_by_state(tb.posts(spark, sf, LABEL_COLUMNS), tb.states(spark, sf), tb.lexicon(spark), tb.TOPICS)


# -- ingest / projection ----------------------------------------------------
def capture_lines(spark, sf) -> DataFrame:
    return capture_lines_of(tb.table(spark, sf, "events"))


def capture_lines_of(e: DataFrame) -> DataFrame:
    """Capture-style JSON lines derived from events: id, post-style date,
    nested user object and the raw ``props`` object."""
    line = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"),
        F.lit(',"created_at":"'), F.date_format("ts", "EEE MMM dd HH:mm:ss +0000 yyyy"),
        F.lit('","lang":"'), F.col("event_type"),
        F.lit('","user":{"id":'), F.col("user_id").cast("string"),
        F.lit(',"location":null},"props":'), F.col("props"), F.lit("}"))
    return e.select(line.alias("value"))


def q_flatten_props(spark, sf):
    from ..sources.jsonl import parse_lines
    raw = parse_lines(capture_lines(spark, sf))
    paths = [(("lang",), "string"), (("user", "id"), "bigint"), (("user", "location"), "string"),
             (("props", "k"), "bigint"), (("props", "absent"), "string"), (("lang", "deeper"), "string")]
    flat = P.flatten(raw, paths, sep="_")
    return flat.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def q_first_text(spark, sf):
    """The first of three candidates: the last answer of the user's conversation, all that the user says
    in it, and the document."""
    e = tb.table(spark, sf, "events").select("event_id", "user_id")
    d = tb.table(spark, sf, "documents").select("doc_id", F.col("text").alias("doc_text"))
    last = F.max_by(F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.struct("turn", F.coalesce("text", F.lit("")))))
    own = F.sort_array(F.collect_list(F.when(F.col("role") == "user", F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))))
    told = tb.table(spark, sf, "conversations").groupBy("conv_id").agg(last.alias("reply_text"), own.alias("_own"))
    told = told.withColumn("desc_text", F.when(F.size("_own") > 0, F.array_join("_own.text", "\n")))
    j = e.join(told, e.user_id == told.conv_id, "left").join(d, e.event_id == d.doc_id, "left")
    out = P.first_text(j.select("event_id", "reply_text", "desc_text", "doc_text"), "full_text",
                       ["reply_text", "desc_text", "doc_text"], drop=True)
    return out.select(F.col("event_id").alias("id"), F.octet_length("full_text").alias("n_bytes"),
                      F.md5("full_text").alias("text_md5"))


def drifting_lines(spark, sf) -> DataFrame:
    """The events' capture lines, of which some hold a key of another type or one that no path declares."""
    e = capture_lines(spark, sf)
    odd = F.when(F.col("value").contains('"lang":"error"'), F.lit(',"score":"high"}')).when(
        F.col("value").contains('"lang":"view"'), F.lit(',"score":1.5,"flags":{"kept":true}}')).otherwise(F.lit("}"))
    return e.select(F.concat(F.regexp_replace("value", r"\}$", ""), odd).alias("value"))


def q_schema_drift(spark, sf):
    from ..operators.drift import drift
    from ..sources.jsonl import parse_lines
    paths = [(("lang",), "string"), (("user", "id"), "string"), (("user", "location"), "string"), (("props", "k"), "bigint"),
             (("props", "absent"), "string"), (("score",), "double"), (("place", "name"), "string")]
    return drift(parse_lines(drifting_lines(spark, sf)), paths, roots=["id"])


def q_store_between_times(spark, sf):
    """A time range of the posts that a streaming job stored by day."""
    from ..streaming.store import read_store, start_store
    out = fresh_folder(spark, "store")
    paths = [(("lang",), "string"), (("user", "id"), "bigint")]
    start_store(spark, capture_lines_of(event_stream(spark, sf)), f"{out}/posts", f"{out}/checkpoint", paths, available_now=True).awaitTermination()
    got = read_store(spark, f"{out}/posts", "2024-01-05 00:00:00+01:00", "2024-01-20 12:00:00+00:00")
    return got.select("id", F.col("created_at").cast("timestamp_ntz").alias("created_at"), "lang", F.col("user-id").alias("user_id"))


def q_preview_posts(spark, sf):
    p = FL.keep_lang(tb.posts(spark, sf, ("id", "lang", "user_location")), "en")
    return P.select_preview(p, ["id", "lang", "user_location"], n=5, order_by="id")


# -- filters ------------------------------------------------------------------
def q_between_times(spark, sf):
    e = tb.table(spark, sf, "events").select("event_id", "ts", "user_id")
    return FL.between_times(e, "2024-01-05 00:00:00+01:00", "2024-01-20 12:00:00+00:00", col="ts")


def q_keep_lang(spark, sf):
    d = tb.table(spark, sf, "documents").select("doc_id", "lang", "source")
    return FL.keep_lang(d, "en", "lang")


def q_track_keywords(spark, sf):
    d = tb.table(spark, sf, "documents").select("doc_id", "text")
    return FL.track_keywords(d, tb.TRACK_WORDS, cols=["text"]).select("doc_id")


def q_track_keywords_ref(spark, sf):
    """The original keyword list over documents with a mention appended by language, of which some
    only look like a keyword."""
    from ..constants import KEYWORDS_3
    d = tb.table(spark, sf, "documents").select("doc_id", "lang", "text")
    mention = F.when(F.col("lang") == "en", " @JoeBiden!").when(F.col("lang") == "de", " a trumpet").otherwise("")
    return FL.track_keywords(d.withColumn("text", F.concat("text", mention)), KEYWORDS_3, cols=["text"]).select("doc_id")


# -- features ------------------------------------------------------------------
def q_topic_flags(spark, sf):
    p = tb.posts(spark, sf, ("id", "full_text", "user_description"))
    f = FE.topic_flags(p, tb.TOPICS, text_cols=["full_text", "user_description"], sep="_")
    return f.drop("full_text", "user_description")


def q_sentiment_scores(spark, sf):
    from ..operators.sentiment import sentiment_carry
    p = tb.posts(spark, sf, ("id", "full_text", "user_description"))
    return sentiment_carry(p, tb.lexicon(spark), text_cols=["full_text", "user_description"], carry=["id"],
                           sep="_")


def q_sentiment_turns(spark, sf):
    """Level 0 and rule scores of every turn; the conversation id repeats, turns are told apart by content."""
    from ..operators.sentiment import sentiment_carry
    from ..operators.sentiment_rules import sentiment_rules
    t = tb.table(spark, sf, "conversations").select("conv_id", F.col("text").alias("turn_text"))
    plain = sentiment_carry(t, tb.lexicon(spark), ["turn_text"], sep="_")
    both = sentiment_rules(plain, tb.lexicon(spark), tb.boosters(spark), tb.negations(spark), ["turn_text"], compound="rules",
                           sep="_", carry=["conv_id", "turn_text_sentiment_compound"])
    return both


def q_sentiment_idioms(spark, sf):
    """Rule scores with an idiom table and emoticons in the lexicon."""
    from ..operators.sentiment_rules import sentiment_rules
    d = tb.ended_documents(spark, sf)
    s = sentiment_rules(d, tb.marked_lexicon(spark), tb.boosters(spark), tb.negations(spark), ["text"], keep_struct=True, sep="_",
                        carry=["id"], idioms=tb.idioms(spark))
    return s.select("id", "text_sentiment_compound", F.col("text_sentiment.pos").alias("pos"), F.col("text_sentiment.neg").alias("neg"))


def q_sentiment_marks(spark, sf):
    """Level 0 with emoticons."""
    from ..operators.sentiment import sentiment_carry
    return sentiment_carry(tb.ended_documents(spark, sf), tb.marked_lexicon(spark), ["text"], carry=["id"], sep="_", marks=True)


def q_map_feed_geojson(spark, sf):
    """Feature strings over states of which some have no posts, with a WKT geometry column."""
    from ..sinks.feeds import map_feed
    p = _labelled(spark, sf).filter(F.col("state") != "NATION_0")
    m = S.add_majority(tb.states(spark, sf), p, "label", "state", "name", count_col="user_id", out="cluster_max_label")
    ring = F.concat(F.lit("((0 0, "), F.col("ord"), F.lit(" 0, "), F.col("ord"), F.lit(" 1.5, 0 0), (.1 .1, 0.2 .1, 0.2 0.2, .1 .1))"))
    wkt = (F.when(F.col("ord") % 4 == 0, F.concat(F.lit("POINT ("), F.col("ord"), F.lit(" -0.5)")))
           .when(F.col("ord") % 4 == 1, F.concat(F.lit("POLYGON "), ring))
           .when(F.col("ord") % 4 == 2, F.concat(F.lit("SRID=4326;MultiPolygon ("), ring, F.lit(",((5 5, 6 5,6 6 , 5 5)))"))))
    m = m.withColumn("geometry", wkt)
    return map_feed(m, "cluster_max_label").select("name", "feature")


def q_sentiment_struct(spark, sf):
    d = tb.spread(tb.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text")))
    s = sentiment(d, tb.lexicon(spark), text_cols=["text"], key="id", keep_struct=True, sep="_")
    return s.select("id", F.col("text_sentiment.neg").alias("neg"), F.col("text_sentiment.neu").alias("neu"),
                    F.col("text_sentiment.pos").alias("pos"), F.col("text_sentiment.compound").alias("compound"))


def q_sentiment_rules_posts(spark, sf):
    from ..operators.sentiment_rules import sentiment_rules
    p = tb.posts(spark, sf, ("id", "full_text", "user_description"))
    s = sentiment_rules(p, tb.lexicon(spark), tb.boosters(spark), tb.negations(spark),
                        text_cols=["full_text", "user_description"], key="id", carry=["id"], keep_struct=True, sep="_")
    return s.select("id", "full_text_sentiment_compound", F.col("full_text_sentiment.pos").alias("full_text_pos"),
                    F.col("full_text_sentiment.neg").alias("full_text_neg"),
                    "user_description_sentiment_compound")


def q_drop_zero(spark, sf):
    return FL.drop_zero(q_sentiment_scores(spark, sf), "full_text_sentiment_compound")


def q_classes_labels(spark, sf):
    p = _labelled(spark, sf)
    return p.select("id", "full_text_sentiment_compound_class", "label")


def q_topic_subsets(spark, sf):
    p = _labelled(spark, sf)
    a = FL.topic_subset(p, "full_text_topic_a", "full_text_topic_b", "a_only").select("id", F.lit("a_only").alias("subset"))
    b = FL.topic_subset(p, "full_text_topic_a", "full_text_topic_b", "b_only").select("id", F.lit("b_only").alias("subset"))
    return a.unionByName(b)


# -- geo -------------------------------------------------------------------------
def q_state_first(spark, sf):
    p = tb.posts(spark, sf, ("id", "user_location"))
    return G.state_from_text(p, tb.states(spark, sf), "user_location", "state", pick="first",
                             alt_cols=(), order_col="ord").select("id", "state")


def q_state_matches(spark, sf):
    p = tb.posts(spark, sf, ("id", "user_location"))
    m = G.state_matches(p, tb.states(spark, sf), "user_location", "m", alt_cols=(), order_col="ord")
    return m.select("id", F.explode("m").alias("state"))


def q_state_matches_join(spark, sf):
    p = tb.posts(spark, sf, ("id", "user_location"))
    return G.state_matches_join(p, tb.states(spark, sf), "user_location", "state", alt_cols=(),
                                order_col="ord").select("id", "state")


def q_state_matches_alt(spark, sf):
    """Matches by name, abbreviation and phonetic code, over locations that use one of them."""
    us = G.us_states_frame(spark)
    c = tb.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    j = c.join(us, F.col("id") % 50 == F.col("ord"))
    told = F.when(F.col("id") % 3 == 0, F.col("name")).when(F.col("id") % 3 == 1, F.col("abbr")).otherwise(F.col("code"))
    p = j.select("id", F.concat("c_name", F.lit(", "), told).alias("user_location"))
    return G.state_matches_join(p, us, "user_location", "state").select("id", "user_location", "state", F.col("_ord").alias("place"))


def q_gazetteer_state(spark, sf):
    p = tb.posts(spark, sf, ("id", "user_location"))
    g = G.gazetteer_state(p, tb.gazetteer(spark, sf), "user_location", "state2", "coord", key="id")
    return g.select("id", "state2", F.col("coord.lat").alias("lat"), F.col("coord.lon").alias("lon"))


def q_state_from_address(spark, sf):
    return G.state_from_address(tb.addresses(spark, sf), "address", "state").select("id", "state")


# -- aggregates and joins onto the state table -------------------------------------
def q_state_sentiment(spark, sf):
    p = _labelled(spark, sf)
    st = S.describe_by(p, "state", "full_text_sentiment_compound", ("count", "mean", "std"), prefix="compound_")
    return S.join_states(tb.states(spark, sf), st, "name", "state")


def q_state_sentiment_mainland(spark, sf):
    return FL.exclude_values(q_state_sentiment(spark, sf), "name", ["NATION_0", "NATION_1"])


def q_majority_label(spark, sf):
    p = _labelled(spark, sf)
    return S.add_majority(tb.states(spark, sf), p, "label", "state", "name", count_col="user_id",
                          out="cluster_max_label")


def q_describe_by_state(spark, sf):
    return S.describe_by(_labelled(spark, sf), "state", "full_text_sentiment_compound", prefix="c_")


def q_describe_prices(spark, sf):
    """Statistics of an unbounded column with exact quartiles by ranks."""
    li = tb.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("double").alias("price"))
    return S.describe_by(li, ["l_returnflag", "l_linestatus"], "price", prefix="c_", ranked=True)


def q_value_counts_label(spark, sf):
    return S.value_counts(_labelled(spark, sf), "label", "n")


def q_n_unique_label(spark, sf):
    return S.n_unique(_labelled(spark, sf), "label")


def q_histogram_compound(spark, sf):
    p = _labelled(spark, sf)
    a, b = F.col("full_text_topic_a"), F.col("full_text_topic_b")
    return S.histogram(p, "full_text_sentiment_compound",
                       {"all": F.lit(True), "a_only": a & ~b, "b_only": ~a & b}, bins=20)


def q_ratios(spark, sf):
    p = tb.posts(spark, sf, ("id", "lang", "user_description", "user_location"))
    located = G.state_from_text(p, tb.states(spark, sf), "user_location", "state", alt_cols=(), order_col="ord")
    return S.ratios(located, "lang", "en", place_col="user_description", state_col="state")


def q_retention(spark, sf):
    return S.retention(tb.posts(spark, sf, ("id",)), _labelled(spark, sf))


def q_shape_posts(spark, sf):
    return S.shape(tb.posts(spark, sf))


def q_states_with_posts(spark, sf):
    return S.states_with_posts(tb.states(spark, sf), _labelled(spark, sf), "name", "state", present=True)


def q_states_without_posts(spark, sf):
    return S.states_with_posts(tb.states(spark, sf), _labelled(spark, sf), "name", "state", present=False)


def q_union_states(spark, sf):
    """Nations and, as regions of their own, the region table: two state tables in one."""
    from ..sources.states import state_dim
    n = tb.table(spark, sf, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"),
                                             F.col("n_regionkey").alias("region"), F.lit("nation").alias("level"))
    r = tb.table(spark, sf, "region").select(F.col("r_regionkey").alias("ord"), F.col("r_name").alias("name"),
                                             F.col("r_regionkey").alias("region"), F.lit("region").alias("level"))
    return state_dim([n, r], ["ord", "name", "region"])


def q_hist_paths(spark, sf):
    from ..sinks.feeds import state_histogram_paths
    p = _labelled(spark, sf)
    return state_histogram_paths(tb.states(spark, sf), p, label="label", path=HIST_PATH, states_key="name",
                                 state_col="state", out="hist_label")


def q_map_feed(spark, sf):
    from ..sinks.feeds import map_feed_columns
    p = _labelled(spark, sf)
    m = S.add_majority(tb.states(spark, sf), p, "label", "state", "name", count_col="user_id",
                       out="cluster_max_label")
    return map_feed_columns(m, fill_col="cluster_max_label", keep=["ord", "name"])


# -- clustering ----------------------------------------------------------------------
def _event_features(spark, sf):
    e = tb.table(spark, sf, "events")
    return e.select("event_id", F.col("value").alias("f_value"), F.col("user_id").cast("double").alias("f_user"),
                    F.hour("ts").cast("double").alias("f_hour"))


FEATS = ["f_value", "f_user", "f_hour"]


def q_standardize_events(spark, sf):
    return C.standardize(_event_features(spark, sf), FEATS, keep=["event_id"])


# FIXED VALUES: centres (standardised value, user, hour) of the assignment job.
CENTERS = [[-1.0, -1.0, 0.0], [-1.0, 1.0, 0.5], [1.0, -1.0, -0.5], [1.0, 1.0, 0.0]]


def q_assign_clusters(spark, sf):
    z = C.standardize(_event_features(spark, sf), FEATS, keep=["event_id"])
    return C.assign_clusters(z, FEATS, CENTERS, out="cluster").select("event_id", "cluster")


def q_sse_k1(spark, sf):
    z = C.standardize(_event_features(spark, sf), FEATS, keep=["event_id"])
    return C.total_sse(z, FEATS).select(F.lit(1).alias("k"), F.round("sse", 4).alias("sse"))


def q_elbow_lineitem(spark, sf):
    li = tb.table(spark, sf, "lineitem").select("l_quantity")
    curve = C.binned_sse_curve(li, "l_quantity", max_k=10)
    return C.elbow_frame(curve).select("k", F.round("sse", 2).alias("sse"), "is_elbow")


def q_kmeans_events(spark, sf):
    z = C.standardize(_event_features(spark, sf), FEATS, keep=["event_id"])
    return C.kmeans(z, FEATS, k=4, seed=20, key="event_id", out="cluster").select(
        "event_id", "cluster")


def q_kmeans_elbow_events(spark, sf):
    f = _event_features(spark, sf)
    return C.km(f, FEATS, n_cluster=None, seed=20, key="event_id", out="kmlabel_opt").select("event_id", "kmlabel_opt")


# -- capture message handling (batch form over derived messages) ----------------------
def q_route_messages(spark, sf):
    m = CAP.messages_from_events(tb.table(spark, sf, "events"))
    return CAP.route_messages(m, "value", "kind").select("id", "kind")


def q_delete_notices(spark, sf):
    m = CAP.messages_from_events(tb.table(spark, sf, "events"))
    return CAP.delete_notices(CAP.route_messages(m, "value", "kind"), "value")


def q_missed_counter(spark, sf):
    m = CAP.messages_from_events(tb.table(spark, sf, "events"))
    return CAP.missed_counter(CAP.route_messages(m, "value", "kind"), "value")


def q_warning_messages(spark, sf):
    m = CAP.messages_from_events(tb.table(spark, sf, "events"))
    return CAP.warning_messages(CAP.route_messages(m, "value", "kind"), "value").select("id", "message")


def event_stream(spark, sf):
    """The events table as a stream (a pattern, since a stream reads folders or patterns only)."""
    schema = tb.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/event[s].parquet")


def q_stream_message_totals(spark, sf):
    """Totals by kind of a stream over the events' messages, as the table sink holds them."""
    from ..streaming import totals as T
    out = fresh_folder(spark, "totals")
    T.start_totals(event_stream(spark, sf), lambda e: T.message_totals(CAP.messages_from_events(e)), out, f"{out}/checkpoint", available_now=True).awaitTermination()
    return T.read_totals(spark, out, "kind")


def q_stream_capture_rolling(spark, sf):
    """Lines a file of a capture that rolls at 200 records over the events' messages, capped at three
    quarters of the statuses."""
    from ..streaming.rolling import RollingSink
    out = fresh_folder(spark, "capture")
    messages = CAP.messages_from_events(event_stream(spark, sf))
    kept = CAP.capture_frame(messages, ["view"]).select("value")
    nb = 3 * tb.table(spark, sf, "events").filter("event_type = 'view'").count() // 4
    sink = RollingSink(spark, f"{out}/files", f"{out}/state", "streamer", 200, nb)
    kept.writeStream.foreachBatch(sink.step).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    lines = spark.read.schema("value string, file string").option("basePath", f"{out}/files").text(f"{out}/files")
    number = F.regexp_extract("file", r"_(\d+)$", 1).cast("long")
    return lines.groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("n"))


def q_capture_filter(spark, sf):
    m = CAP.messages_from_events(tb.table(spark, sf, "events"))
    return CAP.capture_frame(m, tb.TRACK_WORDS_CAPTURE, "value").select("id")


QUERIES = {
    "label_counts_by_state": q_label_counts_by_state,
    "flatten_props": q_flatten_props,
    "schema_drift": q_schema_drift,
    "store_between_times": q_store_between_times,
    "first_text": q_first_text,
    "preview_posts": q_preview_posts,
    "between_times": q_between_times,
    "keep_lang": q_keep_lang,
    "track_keywords": q_track_keywords,
    "track_keywords_ref": q_track_keywords_ref,
    "topic_flags": q_topic_flags,
    "sentiment_scores": q_sentiment_scores,
    "sentiment_turns": q_sentiment_turns,
    "sentiment_idioms": q_sentiment_idioms,
    "sentiment_marks": q_sentiment_marks,
    "sentiment_struct": q_sentiment_struct,
    "sentiment_rules_posts": q_sentiment_rules_posts,
    "drop_zero": q_drop_zero,
    "classes_labels": q_classes_labels,
    "topic_subsets": q_topic_subsets,
    "state_first": q_state_first,
    "state_matches": q_state_matches,
    "state_matches_join": q_state_matches_join,
    "state_matches_alt": q_state_matches_alt,
    "gazetteer_state": q_gazetteer_state,
    "state_from_address": q_state_from_address,
    "state_sentiment": q_state_sentiment,
    "state_sentiment_mainland": q_state_sentiment_mainland,
    "majority_label": q_majority_label,
    "describe_by_state": q_describe_by_state,
    "describe_prices": q_describe_prices,
    "value_counts_label": q_value_counts_label,
    "n_unique_label": q_n_unique_label,
    "histogram_compound": q_histogram_compound,
    "ratios": q_ratios,
    "retention": q_retention,
    "shape_posts": q_shape_posts,
    "states_with_posts": q_states_with_posts,
    "states_without_posts": q_states_without_posts,
    "union_states": q_union_states,
    "hist_paths": q_hist_paths,
    "map_feed": q_map_feed,
    "map_feed_geojson": q_map_feed_geojson,
    "standardize_events": q_standardize_events,
    "assign_clusters": q_assign_clusters,
    "sse_k1": q_sse_k1,
    "elbow_lineitem": q_elbow_lineitem,
    "kmeans_events": q_kmeans_events,
    "kmeans_elbow_events": q_kmeans_elbow_events,
    "route_messages": q_route_messages,
    "delete_notices": q_delete_notices,
    "missed_counter": q_missed_counter,
    "warning_messages": q_warning_messages,
    "capture_filter": q_capture_filter,
    "stream_message_totals": q_stream_message_totals,
    "stream_capture_rolling": q_stream_capture_rolling,
}
