"""Quality rules by suffix-array repetition.

Per text, a suffix array over its words (prefix doubling) and the longest common prefixes of
neighbouring suffixes give, for each word position, the longest repeat that starts there: the
LCP interval of greatest depth around that suffix. Every occurrence of every maximal repeat of
at least ``min_words`` words lies in such a span, so their union is the text's repeated part.
A text is rejected where that part or the longest repeat is too large.

Many texts share one suffix array; the text's number leads the sort key, so repeats never cross
texts. The work is one narrow pass: no shuffle, memory bounded by a slice of texts (a single
very long text is a slice alone).

Defined cases: a null or empty text has no words, all counts 0, and fails the base rule; rows are
judged one by one, so repeated rows and null ids pass through; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import appended, map_columns, sliced

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")
SLICE_CHARS = 1_500_000


@dataclass(frozen=True)
class RepeatRules:
    """``min_words``: shortest repeat that counts. A text fails if its repeats cover over
    ``max_covered`` of its words, or if one repeat has over ``max_longest`` words.

    The limits lie below the base rule's: a text that passes it repeats at most 20 % of its words,
    so repeats of 10 words or more reject it from 10 % on, and in texts of over 1,020 words the
    longest repeat does so before that."""

    min_words: int = 10
    max_covered: float = 0.1
    max_longest: int = 50


def suffix_array(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of ``words`` (``doc`` ascending, ``end``: one past each position's text) and the
    ranks by the first 2, 4, 8, ... words, as far as ties last."""
    n = len(words)
    v = int(words.max()) + 2
    nxt = np.arange(1, n + 1)
    if (int(doc[-1]) + 1) * v * v >= 1 << 62:
        _, words = np.unique(doc * v + words, return_inverse=True)
        head, v = words, int(words.max()) + 2
    else:
        head = doc * v + words
    follow = np.where(nxt < end, words[np.minimum(nxt, n - 1)] + 1, 0)
    key = head * v + follow
    order = np.argsort(key, kind="stable")
    at = np.arange(n)  # places in the order whose suffixes are still tied or new
    old, new = np.zeros(n, np.int64), key[order]
    rank = np.empty(n, np.int64)
    ranks: list[np.ndarray] = []
    width = 2
    while True:
        first = np.ones(len(at), bool)
        first[1:] = (new[1:] != new[:-1]) | (old[1:] != old[:-1])
        start = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        rank[order[at]] = start
        ranks.append(rank.copy())
        last = np.ones(len(at), bool)
        last[:-1] = first[1:]
        at = at[~(first & last)]
        if not len(at):
            return order, ranks
        p = order[at]
        q = p + width
        old = rank[p]
        new = np.where(q < end[p], rank[np.minimum(q, n - 1)] + 1, 0)
        by = np.lexsort((new, old))
        order[at] = p[by]
        old, new = old[by], new[by]
        width *= 2


def longest_repeats(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position, the words of the longest repeat that starts there, as far as it has at
    least 2 (shorter ones: 0)."""
    n = len(words)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    order, ranks = suffix_array(words, doc, end)
    a, b = order[:-1], order[1:]
    tied = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b = a[tied], b[tied]
    i, j, lcp = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (i < end[a]) & (j < end[b])
        same = inside & (ranks[level][np.minimum(i, n - 1)] == ranks[level][np.minimum(j, n - 1)])
        step = same * (2 << level)
        i, j, lcp = i + step, j + step, lcp + step
    inside = (i < end[a]) & (j < end[b])
    lcp += inside & (words[np.minimum(i, n - 1)] == words[np.minimum(j, n - 1)])
    np.maximum.at(out, a, lcp)
    np.maximum.at(out, b, lcp)
    return out


def covered(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Which of ``n`` places the union of the spans holds."""
    edge = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + lengths, minlength=n + 1)[: n + 1]
    return np.cumsum(edge[:n]) > 0


def text_counts(texts: list[str | None], min_words: int) -> dict[str, list[int]]:
    """The counts of each text (see ``repetition``)."""
    texts = [t or "" for t in texts]
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    parts = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in (t.encode().split() for t in texts)]
    sizes = np.array([len(p) for p in parts], np.int64)
    out = {"n_words": sizes, "n_repeat_words": np.zeros_like(sizes), "n_covered_words": np.zeros_like(sizes), "longest_repeat": np.zeros_like(sizes)}
    n = int(sizes.sum())
    if n:
        words, doc = np.concatenate(parts), np.repeat(np.arange(len(texts)), sizes)
        longest = longest_repeats(words, doc, np.cumsum(sizes)[doc])
        for name, least, length in (("n_repeat_words", WINDOW, WINDOW), ("n_covered_words", min_words, None)):
            starts = np.flatnonzero(longest >= least)
            inside = covered(n, starts, longest[starts] if length is None else length)
            out[name] = np.bincount(doc[inside], minlength=len(texts))
        long = np.where(longest >= min_words, longest, 0)
        np.maximum.at(out["longest_repeat"], doc, long)
    made = {k: v.tolist() for k, v in out.items()}
    made["word_chars"] = [len(t) - sum(map(t.count, WHITE)) for t in texts]
    made["n_symbols"] = [sum(map(t.count, SYMBOLS)) for t in texts]
    lines = [[x for x in t.split("\n") if x.strip(WHITE)] for t in texts]
    made["n_dup_lines"] = [len(x) - len(set(x)) for x in lines]
    return made


def repetition(docs: DataFrame, rules: RepeatRules = RepeatRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the base counts, ``n_covered_words`` (words in the union of the
    repeats), ``longest_repeat`` (words), ``base_failed`` and ``kept``."""
    schema = docs.select(F.col(id_col)).schema[0]
    least = rules.min_words

    def run(batches):
        for batch in sliced(batches, text_col, SLICE_CHARS):
            yield {id_col: batch[id_col]} | text_counts(batch[text_col], least)

    counts = map_columns(docs.select(id_col, text_col), run, f"`{id_col}` {schema.dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS))
    return judged(counts, rules)


def judged(counts: DataFrame, rules: RepeatRules) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    fine = (F.col("n_covered_words") <= rules.max_covered * F.col("n_words")) & (F.col("longest_repeat") <= rules.max_longest)
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def keep_good(docs: DataFrame, rules: RepeatRules = RepeatRules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept. Judged in the same pass, no join."""
    least = rules.min_words
    rows = appended(docs, text_col, lambda texts: text_counts(texts, least), ", ".join(f"{c} long" for c in COUNTS), SLICE_CHARS)
    return judged(rows, rules).filter("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
