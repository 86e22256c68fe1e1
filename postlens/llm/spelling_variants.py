"""Spelling variants by search schemes over FM-indexes of the delimited vocabulary.

The vocabulary is counted with map-side sums. Two words at distance one share their first or their
second half (by the query word's middle), so there are two searches: one matches the first half
exactly from the left delimiter on and extends to the right across the second half, allowing one
error; the other matches the second half exactly up to the right delimiter and extends to the left.
Both end at the other delimiter, so whole words match. An index is bidirectional by its two rank
tables, of the text and of the reversed text; since words are delimited, each search extends one
way only and needs the table of its way, so the two searches run in different tasks.

A half has three code points at least. So the words with the same first (last) three code points are
dealt to a task as one group, whole groups share an index, and a group of more than ``BLOCK`` words
is cut into blocks: each block is an index, which all words of the group are searched in. Words
stream past an index; no task holds more than one block and one slice of queries.

Inside an index all queries of a slice move in step: an interval of suffix ranks for each, extended
by ranks of the next code point. Where an error may happen, the code points that an interval holds
are listed once for each distinct interval (intervals of equally long patterns are disjoint, so a
step lists each row once at most), and each branch goes on exactly. What a search returns is
one row a word (its number of near words and the best one), never the pairs.

Defined cases: a null or empty text has no words; a null id is written as an empty string before the
colon; ties between forms go to the smallest word by code points; repeated rows count as often as
they come; an empty table gives an empty result; extra columns aren't read; a very long text or word
is taken whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_repeats import suffix_array
from .store import map_columns, written, written_side

#: Latin-1 bytes of a text as word bytes: a-z, lower-cased A-Z and U+00C0 to U+00FF; every other
#: code point separates words (those beyond Latin-1 become "?").
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))

HALF = 3  # code points that every half has
BLOCK = 1 << 16
GROUPED = 1 << 15
QUERIES = 1 << 13
TASK_WORDS = 50_000
HELD = 250_000


@dataclass(frozen=True)
class VariantRules:
    """``least``: code points of a word; ``seen``: its occurrences; ``factor``: how many times as
    often a form occurs; ``slip``: divisor of the hashes at which a code point is deleted."""

    least: int = 7
    seen: int = 2
    factor: int = 10
    slip: int = 31


def slipped(doc_id, text: str | None, rules: VariantRules) -> Counter:
    """The words of one text, as Latin-1 bytes, with their occurrences."""
    parts = (text or "").encode("latin-1", "replace").translate(LETTERS).split()
    runs = Counter(p for p in parts if len(p) >= rules.least)
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % rules.slip == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= rules.least:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, rules: VariantRules, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences."""

    def rows(held: Counter) -> dict[str, list]:
        return {"word": [w.decode("latin-1") for w in held], "n": list(held.values())}

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"], strict=True):
                for word, n in slipped(key, text, rules).items():
                    held[word] += n
                if len(held) >= HELD:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    counts = map_columns(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rules.seen)


class VocabularyIndex:
    """An FM-index over distinct words, each between delimiters; patterns grow to the left."""

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\x01" + b"\x01".join(words) + b"\x01", np.uint8)
        symbols = np.flatnonzero(np.bincount(text, minlength=256))
        self.code = np.full(256, len(symbols) + 1, np.int64)  # code points that don't occur match nothing
        self.code[symbols] = np.arange(1, len(symbols) + 1)  # the delimiter is 1, the end of the text 0
        codes, n = self.code[text], len(text)
        order, _ = suffix_array(codes, np.zeros(n, np.int64), np.full(n, n))
        suffix = np.concatenate([[n], order])
        self.before = np.where(suffix > 0, codes[suffix - 1], 0)
        self.rows = n + 1
        by = np.argsort(self.before, kind="stable")
        self.ranks = self.before[by] * self.rows + by
        self.step = np.empty(self.rows, np.int64)
        self.step[by] = np.arange(self.rows)
        self.first, self.last = (int(x) for x in np.searchsorted(self.ranks, np.array([1, 2]) * self.rows))
        starts = np.cumsum([1, *[len(w) + 1 for w in words[:-1]]])
        self.word = np.searchsorted(starts, suffix[self.first : self.last] + 1)

    def extended(self, symbol, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with ``symbol`` before them."""
        return np.searchsorted(self.ranks, symbol * self.rows + low), np.searchsorted(self.ranks, symbol * self.rows + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, symbol, low, high) for each code point before the pattern of each interval."""
        both, where = np.unique(low * (self.rows + 1) + high, return_inverse=True)
        a, b = np.divmod(both, self.rows + 1)
        width = b - a
        begin = np.cumsum(width) - width
        row = np.arange(int(width.sum())) - np.repeat(begin - a, width)
        key, at, count = np.unique(np.repeat(np.arange(len(both)), width) * 512 + self.before[row], return_index=True, return_counts=True)
        owner, symbol = np.divmod(key, 512)
        fine = symbol > 1
        owner, symbol, count, at = owner[fine], symbol[fine], count[fine], at[fine]
        child = self.step[row[at]]
        start = np.searchsorted(owner, np.arange(len(both) + 1))
        many = (start[1:] - start[:-1])[where]
        place = np.repeat(np.arange(len(low)), many)
        pick = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many) + start[where][place]
        return place, symbol[pick], child[pick], child[pick] + count[pick]

    def near(self, queries: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs at distance one whose last ``exact`` code points are equal, each once.

        ``q``, ``low``, ``high``: the searches without an error, in step; ``e``: rows (query, code points
        left, low, high) of those with one. In a run of equal code points only one place errs."""
        sizes = np.array([len(x) for x in queries])
        flat = self.code[np.frombuffer(b"".join(queries), np.uint8)]
        off = np.array([0, *accumulate(sizes.tolist())][:-1])
        q = np.arange(len(queries))
        low, high = np.full(len(q), self.first), np.full(len(q), self.last)
        e = np.empty((4, 0), np.int64)
        found, matched, many = [], 0, len(self.word) + 1
        while len(q) or e.shape[1]:
            left = sizes[q] - matched
            here = np.flatnonzero(matched >= exact[q])
            if len(here):
                e = np.concatenate([e, self._errors(flat, off, q[here], left[here], low[here], high[here])], axis=1)
            done = e[1] == 0
            if done.any():
                x, y = self.extended(1, e[2, done], e[3, done])
                hit = y > x
                found.append(e[0, done][hit] * many + self.word[x[hit] - self.first])
                e = e[:, ~done]
            if e.shape[1]:
                e[1] -= 1
                e[2], e[3] = self.extended(flat[off[e[0]] + e[1]], e[2], e[3])
                e = e[:, e[3] > e[2]]
            go = np.flatnonzero(left > 0)
            q, low, high = q[go], low[go], high[go]
            low, high = self.extended(flat[off[q] + left[go] - 1], low, high)
            alive = high > low
            q, low, high = q[alive], low[alive], high[alive]
            matched += 1
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.divmod(np.unique(np.concatenate(found)), many)

    def _errors(self, flat: np.ndarray, off: np.ndarray, q: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The searches that go on with an error made here: another code point in place of the
        query's next one, one more before it, or none for it."""
        place, symbol, a, b = self.branches(low, high)
        some = left > 0
        own = np.where(some, flat[np.maximum(off[q] + left - 1, 0)], 0)
        other = symbol != own[place]
        place, a, b = place[other], a[other], b[other]
        change = some[place]
        skip = np.flatnonzero(some & ((left < 2) | (own != flat[np.maximum(off[q] + left - 2, 0)])))
        return np.array([
            np.concatenate([q[place[change]], q[place], q[skip]]),
            np.concatenate([left[place[change]] - 1, left[place], left[skip] - 1]),
            np.concatenate([a[change], a, low[skip]]),
            np.concatenate([b[change], b, high[skip]]),
        ])


class Side:
    """One search over one index: ``side`` 0 matches first halves exactly, 1 second halves."""

    def __init__(self, side: int, words: list[bytes], counts: list[int]):
        self.side, self.words = side, words
        self.counts = np.array(counts, np.int64)
        self.order = np.empty(len(words), np.int64)
        self.order[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
        self.index = VocabularyIndex(words if side else [w[::-1] for w in words])

    def best(self, queries: list[bytes]) -> dict[str, list]:
        """The queries with near words: how many, and the one of most occurrences."""
        half = np.array([len(w) // 2 for w in queries])
        if self.side:
            q, x = self.index.near(queries, np.array([len(w) for w in queries]) - half)
            # words that share the first half too are the other search's
            own = np.array([not self.words[b].startswith(queries[a][: half[a]]) for a, b in zip(q.tolist(), x.tolist(), strict=True)], bool)
            q, x = q[own], x[own]
        else:
            q, x = self.index.near([w[::-1] for w in queries], half)
        by = np.lexsort((self.order[x], -self.counts[x], q))
        q, x = q[by], x[by]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        n = np.diff(np.append(first, len(q)))
        return {
            "word": [queries[i].decode("latin-1") for i in q[first].tolist()],
            "n_near": n.tolist(),
            "form": [self.words[i].decode("latin-1") for i in x[first].tolist()],
            "form_n": self.counts[x[first]].tolist(),
        }


def search_side(dealt: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) from rows (side, key, block, blocks, held, word, n) that lie by
    side, key and block, the words held by an index before the others that are searched in it."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        group, alone = None, False
        words: list[bytes] = []
        counts: list[int] = []
        others: list[bytes] = []
        index: Side | None = None

        def searched(queries: list[bytes]) -> Iterator[dict[str, list]]:
            nonlocal index
            if words and queries:
                index = index or Side(group[0], words, counts)
                for i in range(0, len(queries), QUERIES):
                    yield index.best(queries[i : i + QUERIES])

        for batch in batches:
            for side, key, block, blocks, held, word, n in zip(*(batch[c] for c in ("side", "key", "block", "blocks", "held", "word", "n")), strict=True):
                here = (side, key, block)
                if here != group:
                    if group is not None and (alone or blocks > 1 or side != group[0] or len(words) >= GROUPED):
                        yield from searched(others)
                        yield from searched(words)
                        words, counts, others, index = [], [], [], None
                    group, alone = here, blocks > 1
                if held:
                    words.append(word.encode("latin-1"))
                    counts.append(n)
                else:
                    others.append(word.encode("latin-1"))
                    if len(others) >= QUERIES:
                        yield from searched(others)
                        others = []
        if group is not None:
            yield from searched(others)
            yield from searched(words)

    return map_columns(dealt, run, "word string, n_near long, form string, form_n long")


def near_words(words: DataFrame, least: int) -> DataFrame:
    """(word, n, n_near, form_n, form) for the rows (word, n) of a written vocabulary of words of at
    least ``least`` code points: the number of words at distance one, and the best of them."""
    if least < 2 * HALF:
        raise ValueError(f"words of fewer than {2 * HALF} code points have halves below {HALF}")
    ends = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, HALF).alias("key")),
        F.struct(F.lit(1).alias("side"), F.substring("word", -HALF, HALF).alias("key")),
    )
    sides = words.select("word", "n", F.explode(ends).alias("e")).select("e.side", "e.key", "word", "n")
    large = sides.groupBy("side", "key").count().filter(F.col("count") > BLOCK)
    large = written_side(large.select("side", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("more")), "large-groups")
    cut = sides.join(large, ["side", "key"], "left").withColumn("blocks", F.coalesce("more", F.lit(1))).drop("more")
    dealt = cut.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("held", F.pmod(F.xxhash64("word"), "blocks") == F.col("block"))
    parts = max(1, -(-2 * words.count() // TASK_WORDS))
    placed = dealt.repartition(parts, "side", "key", "block").sortWithinPartitions("side", "key", "block", F.col("held").desc())
    near = search_side(placed.select("side", "key", "block", "blocks", "held", "word", "n"))
    every = near.select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form")).alias("best"))
    nothing = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<m:long,form:string>").alias("best"))
    sums = every.unionByName(nothing).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return sums.select("word", "n", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word when forms are followed. Each step doubles
    the distance followed; a chain grows by ``factor`` a link, so there are few steps."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        ahead = at.join(on, F.col("root") == F.col("__w"), "left")
        after = written(ahead.select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")), "roots")
        at = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return at


def variants(docs: DataFrame, rules: VariantRules = VariantRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row a word of the vocabulary."""
    words = written(vocabulary(docs, rules, id_col, text_col), "vocabulary")
    near = near_words(words, rules.least)
    form = F.col("form_n") >= rules.factor * F.col("n")
    near = written(near.select("word", F.when(form, F.col("form")).alias("form"), "n", "n_near", F.when(form, F.col("form_n")).alias("form_n")), "near-words")
    ends = roots(near.filter("form is not null"))
    found = near.join(ends, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
