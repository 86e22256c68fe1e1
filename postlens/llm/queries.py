"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lexical_packing, rank_bpe, token_files
from .benchmark_automaton import contamination
from .hilbert_search import search
from .passage_minhash import repeated_passages
from .preference_pairs import conversation_pairs, format_pairs
from .quality_repeats import repetition
from .ranked_search import ranked
from .secret_ownership import KINDS, secret_spans
from .simhash_anchors import near_duplicates
from .spelling_variants import variants
from .store import fresh_path
from .url_rules import judge_urls


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents")).drop("longest_repeat")


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_spans(table(spark, sf_dir, "documents"))
    text = lambda keep: F.array_join(F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind_no"] < 3)

    def number(field: str, value: str):
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long").alias(f"n_{value}")

    counts = [number("kind", k) for k in KINDS[:3]]
    live, example = number("verdict", "live"), number("verdict", "example")
    return spans.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), live, example)


def packing_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(lexical_packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    rows = format_pairs(conversation_pairs(table(spark, sf_dir, "conversations")))
    return rows.withColumn("chosen_mask", spans(F.col("chosen_mask"))).withColumn("rejected_mask", spans(F.col("rejected_mask")))


def op3_passage_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("tag")


def op4_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = rank_bpe.round_trip(docs, path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), out, tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.read_tokens(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    labels = table(spark, sf_dir, "labels").select("doc_id", bad)
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", "bad")
    return judge_urls(pages, labelled)


def op10_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_benchmark_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), named, (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (op1_lexical_packing, op2_preference_pairs, op3_passage_minhash, op4_rank_bpe, op5_simhash_anchors, op6_secret_ownership, op7_token_files, op8_url_rules, op9_suffix_repeats, op10_hilbert_search, op11_ranked_search, op12_spelling_variants, op13_benchmark_automaton)}


def oracle_sql() -> dict[str, str]:
    from .oracle import SQL

    return {k: v for k, v in SQL.items() if k in QUERIES}
