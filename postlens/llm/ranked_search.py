"""Ranked lexical search, term at a time with a limit on accumulators.

The documents are indexed once, in shards as they lie: for the terms of the queries, each shard keeps
its postings (document, occurrences) and its documents' lengths. Corpus statistics (documents, terms,
documents that hold a term) are summed over all shards. Nothing but these sums and each task's best
documents is shuffled.

A shard answers each query term by term, the rarest first. A term's bound is its weight times the
greatest factor that any posting of the shard has. A document gets an accumulator when a posting
first names it. Once the bounds of the remaining terms can't lift a new document to the k-th best
partial score (or to the k-th best score of the task's earlier shards), no accumulator is made any
more; accumulators that can't reach that score themselves go, and the survivors are updated exactly
over all remaining terms. A document that could tie with the k-th is never left out, so results
equal scoring everything.

Queries go in blocks of bounded size (``item_blocks``); each block indexes its own terms.

Defined cases: a null, empty or wordless text holds no term and isn't counted; a query without words
(null text, say) has no rows; equal queries (id and text) count once; a query that occurs with several
texts is several queries; a null document id takes part and ranks behind the others on equal
scores; repeated rows are documents of their own; without documents or queries the result is empty;
extra columns aren't read; a very long text is one document of one shard.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .item_blocks import Item, item_blocks, text_words
from .store import map_columns, written

#: Words of query terms, or documents, after which a shard is closed.
SHARD_WORDS = 1 << 20
SHARD_DOCS = 1 << 16
SALTS = 32
INDEX = "doc array<long>, size array<long>, term binary, start binary, post binary, tf binary"


@dataclass(frozen=True)
class SearchRules:
    """``k``: documents a query. ``block_chars``: characters of queries in one block."""

    k: int = 20
    block_chars: int = 1 << 20


def index_shards(docs: DataFrame, terms: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``INDEX`` rows, one a shard: document ids and lengths, and the postings by term, then document."""

    def closed(doc: list, size: list[int], held: list[np.ndarray]) -> dict[str, list]:
        at = np.repeat(np.arange(len(held)), [len(h) for h in held])
        key, tf = np.unique(np.concatenate(held).astype(np.int64) * len(held) + at, return_counts=True)
        term, post = np.divmod(key, len(held))
        first = np.flatnonzero(np.diff(term, prepend=-1))
        parts = {"term": term[first], "start": np.append(first, len(term)), "post": post, "tf": tf}
        return {"doc": [doc], "size": [size]} | {k: [v.astype("<i4").tobytes()] for k, v in parts.items()}

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        doc, size, held, n = [], [], [], 0
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"], strict=True):
                words = text_words(text)
                if not words:
                    continue
                ids = np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))
                ids = ids[ids >= 0]
                doc.append(key)
                size.append(len(words))
                held.append(ids)
                n += len(ids)
                if n >= SHARD_WORDS or len(held) >= SHARD_DOCS:
                    yield closed(doc, size, held)
                    doc, size, held, n = [], [], [], 0
        if held:
            yield closed(doc, size, held)

    return map_columns(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, INDEX)


def statistics(index: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each query term (a vector
    bounded by the block of queries)."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held, n, total = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            for size, term, start in zip(batch["size"], batch["term"], batch["start"], strict=True):
                held[np.frombuffer(term, "<i4")] += np.diff(np.frombuffer(start, "<i4"))
                n += len(size)
                total += sum(size)
        at = np.flatnonzero(held)
        yield {"term": [-2, -1, *at.tolist()], "n": [n, total, *held[at].tolist()]}

    sums = dict(map(tuple, map_columns(index.select("size", "term", "start"), run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()))
    df = np.zeros(n_terms, np.int64)
    for term, n in sums.items():
        if term >= 0:
            df[term] = n
    return sums.get(-2, 0), sums.get(-1, 0), df


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


class Shard:
    """The postings of one shard with their factors under the corpus statistics."""

    def __init__(self, doc: list, size: list[int], arrays: list[bytes], n: int, total: int):
        self.nameless = np.array([x is None for x in doc])
        self.doc = np.array([0 if x is None else x for x in doc], np.int64)
        term, self.start, self.post, tf = (np.frombuffer(a, "<i4") for a in arrays)
        self.place = {t: i for i, t in enumerate(term.tolist())}
        m = 75 + (25 * np.array(size, np.int64) * n) // total
        tf = tf.astype(np.int64)
        self.factor = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.post])
        self.most = np.maximum.reduceat(self.factor, self.start[:-1]).tolist() if len(term) else []

    def search(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that may be among the ``k`` best with a score of at least
        ``floor``. ``query``: (term, weight with its repeats), the rarest first."""
        here = [(self.place[t], w) for t, w in query if t in self.place]
        bounds = [w * self.most[at] for at, w in here]
        left = np.cumsum(bounds[::-1])[::-1].tolist() if bounds else []
        score = np.zeros(len(self.doc), np.int64)
        alive: np.ndarray | None = None  # the places with accumulators, once no more are made
        for j, (at, weight) in enumerate(here):
            span = slice(self.start[at], self.start[at + 1])
            post, factor = self.post[span], self.factor[span]
            if alive is None:
                if j:
                    made = score[score > 0]
                    if len(made) >= k:
                        floor = max(floor, int(np.partition(made, len(made) - k)[len(made) - k]))
                if left[j] < floor:
                    alive = np.flatnonzero(score + left[j] >= max(floor, left[j] + 1))
                else:
                    score[post] += weight * factor
                    continue
            at = np.searchsorted(post, alive)
            at[at == len(post)] = 0
            hit = post[at] == alive
            score[alive[hit]] += weight * factor[at[hit]]
        found = np.flatnonzero(score > 0) if alive is None else alive
        return found, score[found]


def best(score: np.ndarray, nameless: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` best: score, then id, missing ids last."""
    if len(score) > k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((doc[some], nameless[some], -score[some]))][:k]


def search_index(index: DataFrame, queries: list[list[tuple[int, int]]], n: int, total: int, k: int) -> DataFrame:
    """(query, doc_id, score): of each task's shards, the ``k`` best documents a query."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in zip(*(batch[c] for c in ("doc", "size", "term", "start", "post", "tf")), strict=True):
                shard = Shard(row[0], row[1], list(row[2:]), n, total)
                for q, query in enumerate(queries):
                    had = kept.get(q)
                    floor = int(had[0][-1]) if had is not None and len(had[0]) == k else 1
                    found, score = shard.search(query, k, floor)
                    found, score = found[score >= floor], score[score >= floor]
                    if len(found):
                        mine = (score, shard.nameless[found], shard.doc[found])
                        both = mine if had is None else tuple(np.concatenate(x) for x in zip(had, mine, strict=True))
                        top = best(*both, k)
                        kept[q] = tuple(x[top] for x in both)
        for q, (score, nameless, doc) in kept.items():
            yield {"query": [q] * len(score), "doc_id": [None if x else d for x, d in zip(nameless.tolist(), doc.tolist(), strict=True)], "score": score.tolist()}

    return map_columns(index, run, "query long, doc_id long, score long")


def block_ranks(docs: DataFrame, block: list[Item], rules: SearchRules, id_col: str, text_col: str) -> DataFrame:
    """(query, rank, doc_id, score) for the queries of one block, ``query`` by place in it."""
    terms: dict[bytes, int] = {}
    counted = [Counter(terms.setdefault(w, len(terms)) for w in words) for _, words in block]
    index = written(index_shards(docs, terms, id_col, text_col), "search-index")
    n, total, df = statistics(index, len(terms))
    weight = weights(n, df)
    queries = [[(t, int(q * weight[t])) for t, q in sorted(c.items(), key=lambda x: (df[x[0]], x[0])) if df[t]] for c in counted]
    found = search_index(index, queries, n, max(total, 1), rules.k)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # tasks' best are merged in two steps, so that no task reads all tasks' rows of a query
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).filter(F.col("rank") <= rules.k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= rules.k).select("query", "rank", "doc_id", "score")


def ranked(docs: DataFrame, queries: DataFrame, rules: SearchRules = SearchRules(), id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``k`` best documents with a score above 0, best
    first, equal scores by ascending id. The ids keep their columns' types (documents' as long)."""
    spark, made = docs.sparkSession, []
    kind = queries.schema[query_id].dataType.simpleString()
    for block in item_blocks(queries, query_id, query_text, rules.block_chars):
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], "query long, name string")
        rows = block_ranks(docs, block, rules, id_col, text_col).join(F.broadcast(names), "query")
        made.append(rows.select(F.col("name").cast(kind).alias(query_id), "rank", F.col("doc_id").alias(id_col), "score"))
    if not made:
        return spark.createDataFrame([], f"`{query_id}` {kind}, rank int, `{id_col}` long, score long")
    return reduce(DataFrame.unionAll, made)
