"""Stand-in inputs built from the driver's parquet tables.

``posts``: one row per document with the columns a flattened capture has
(id, created_at, lang, full_text, user_id, user_description, user_location).
The description is the user's whole conversation.
Texts are whole documents, never cut. The states are the nation names (so
``NATION_1`` is a substring of ``NATION_19``, the same ambiguity as
``Virginia`` inside ``West Virginia``). All inputs are read lazily from
parquet, so filters and column pruning reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import local_frame, spread

# FIXED VALUES: toy lexicon (token, valence) used by the stand-in queries.
TOY_LEXICON = [
    ("the", 0.4), ("of", -0.9), ("and", 1.3), ("with", 2.1), ("this", -1.7),
    ("that", -2.4), ("is", 1.1), ("for", -0.6), ("was", -2.0),
]
# FIXED VALUES: stand-in boosters (token, scalar) and negation words for the
# rule-based scorer (words that occur in the invented prose).
TOY_BOOSTERS = [("very", 0.293), ("on", 0.293), ("in", -0.293), ("sehr", 0.293)]
TOY_NEGATIONS = ["not", "no", "nicht", "pas"]
# FIXED VALUES: stand-in idioms (phrases of the invented prose) and emoticons.
TOY_IDIOMS = [("of the", 1.6), ("and of the", -2.2), ("is that", 0.7), ("that was", -0.4), ("with and for", 1.1), ("was never so", 2.4)]
TOY_MARKS = [(":)", 1.8), (":-(", -1.9), ("<3", 2.2)]
# FIXED VALUES: what is said at the end of a document of a language in the idiom queries.
TOY_ENDINGS = {"en": " It was never so and this :)", "de": " of the least that, at least with :-(", "es": " kind of is <3 never good this for"}
# FIXED VALUES: stand-in topic patterns (A plays the first candidate, B the second).
TOPIC_A = "(with|from)"
TOPIC_B = "(this|that)"
TOPICS = {"topic_a": TOPIC_A, "topic_b": TOPIC_B}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, user_description): all turns of a conversation in order, one line each."""
    turns = table(spark, sf_dir, "conversations")
    held = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(held, lambda t: t["text"]), "\n").alias("user_description"))


POST_COLUMNS = ("id", "created_at", "lang", "full_text", "user_id", "user_description", "user_location")


def posts(spark: SparkSession, sf_dir: str, columns=POST_COLUMNS) -> DataFrame:
    """Documents joined with their event, all turns of the user's conversation and the user's
    customer/nation location, one row per document. Only the joins that ``columns`` needs are built."""
    texts = [F.col("text").alias("full_text")] if "full_text" in columns else []
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", *texts)
    d = spread(d) if texts else d
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("created_at"), "user_id")
    p = d.join(e, d.id == e.event_id, "inner")
    if "user_description" in columns:
        c = descriptions(spark, sf_dir)
        p = p.join(c, c.conv_id == p.user_id, "left")
    if "user_location" in columns:
        u = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
        n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        users = u.join(n, u.c_nationkey == n.n_nationkey, "left").select(
            "c_custkey", F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")).alias("user_location"))
        p = p.join(users, users.c_custkey == p.user_id, "left")
    return p.select(*columns)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State table stand-in: nation names in key order (``ord``, ``name``)."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"),
                                                 F.col("n_name").alias("name"))


def lexicon(spark: SparkSession) -> DataFrame:
    return local_frame(spark, TOY_LEXICON, "token string, valence double")


def marked_lexicon(spark: SparkSession) -> DataFrame:
    return local_frame(spark, TOY_LEXICON + TOY_MARKS + [("kind", 1.5)], "token string, valence double")


def idioms(spark: SparkSession) -> DataFrame:
    return local_frame(spark, TOY_IDIOMS, "phrase string, valence double")


def ended_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text): every document with its language's ending."""
    ending = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(e)) for lang, e in TOY_ENDINGS.items()], F.lit(""))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select(F.col("doc_id").alias("id"), F.concat("text", ending).alias("text"))


def boosters(spark: SparkSession) -> DataFrame:
    return local_frame(spark, TOY_BOOSTERS, "token string, scalar double")


def negations(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [(w,) for w in TOY_NEGATIONS], "token string")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place-name table stand-in: customer names map to their nation (with
    balance and nation key as coordinates), nation names to their region."""
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation")
    re_ = table(spark, sf_dir, "region")
    a = cu.join(na, cu.c_nationkey == na.n_nationkey, "left").select(
        F.col("c_name").alias("city"), F.col("n_name").alias("state"),
        F.col("c_acctbal").cast("double").alias("lat"), F.col("c_nationkey").cast("double").alias("lon"))
    b = na.join(re_, na.n_regionkey == re_.r_regionkey, "left").select(
        F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.col("n_nationkey").cast("double").alias("lat"), F.col("n_regionkey").cast("double").alias("lon"))
    return a.unionByName(b)


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocoder-style addresses built from customers: the long form
    ``name, segment, nation, United States`` and, for the BUILDING segment,
    the short form ``nation, United States`` that carries no state part."""
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation")
    j = cu.join(na, cu.c_nationkey == na.n_nationkey, "left")
    addr = F.when(F.col("c_mktsegment") == "BUILDING",
                  F.concat(F.col("n_name"), F.lit(", United States"))).otherwise(
        F.concat_ws(", ", F.col("c_name"), F.col("c_mktsegment"), F.col("n_name"), F.lit("United States")))
    return j.select(F.col("c_custkey").alias("id"), addr.alias("address"))


# FIXED VALUES: stand-in tracked words (present in the invented prose, and in
# the derived capture messages).
TRACK_WORDS = ["with", "nicht", "pour"]
TRACK_WORDS_CAPTURE = ["k69", "user8"]
