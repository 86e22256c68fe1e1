"""Benchmark decontamination by a generalised suffix automaton of the items.

The automaton of all items' words reads a text word by word and holds, at each word, the longest
run of words ending there that some item contains. A run of ``window`` words or more lies in an
item, so all its words are hit; the state that holds its last ``window`` words names the items with
that window. An item shorter than the window is one window by itself: its state is marked, and the
marks along the suffix links are gathered beforehand.

Most of a text never meets the automaton: word pairs that no item contains end every match longer
than one word, so a text is cut there, and only stretches as long as the shortest window are read.
The pair table is a bit table by hash, which may let a stretch through and never drops one.

Items go in blocks (``item_blocks``); each task builds its block's automaton from the words, once a
Python process. Texts aren't shuffled: one narrow pass a block, chained, so repeated and null ids
need no key. After ``CHAIN`` blocks the rows are written, which bounds the automata in one task.

Defined cases: a null or empty text has no words and no hits; an item row with a null or wordless
text marks nothing; a null item id marks words but names no item; rows of one item id are one item
with the windows of all; repeated rows are judged one by one; an empty table of documents gives an
empty result, without items nothing is hit; extra columns pass through ``decontaminate`` and aren't
read otherwise; a very long text is a slice alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .item_blocks import WORD_PATTERN, Item, item_blocks, text_words
from .store import sliced, written

SLICE_CHARS = 2_000_000
CHAIN = 4
FOUND = "n_words long, longest long, spans array<struct<start:long,end:long>>, items array<string>"


@dataclass(frozen=True)
class LeakRules:
    """``window``: words of an item in a row that count as a hit. ``block_chars``: characters of items
    in one automaton. ``decontaminate`` removes spans of over ``max_span`` words, and the whole text
    where over ``max_covered`` of its words are hit."""

    window: int = 10
    block_chars: int = 1 << 20
    max_span: int = 9
    max_covered: float = 0.5


class SuffixAutomaton:
    """The generalised suffix automaton of items, with the items of each window."""

    def __init__(self, items: tuple[Item, ...], window: int):
        self.window = window
        self.names = [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        texts = [[self.number.setdefault(w, len(self.number)) for w in words] for _, words in items]
        self.size = max(1, len(self.number))
        self.shortest = min((min(len(t), window) for t in texts), default=1)
        self.edges: dict[int, int] = {}  # state * size + word -> state
        self.words: list[list[int]] = [[]]  # the words that leave a state, for its copies
        self.link, self.length = [0], [0]
        for text in texts:
            last = 0
            for word in text:
                last = self._extend(last, word)
        self._name_windows(texts)
        pairs = np.unique(np.concatenate([np.array(t[:-1], np.int64) * self.size + np.array(t[1:], np.int64) for t in texts])) if texts else np.empty(0, np.int64)
        bits = max(16, int(len(pairs) * 16).bit_length())
        self.mask = (1 << bits) - 1
        self.pairs = np.zeros(1 << bits, bool)
        self.pairs[self._pair_place(pairs)] = True

    def _pair_place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & self.mask

    def _state(self, length: int, link: int) -> int:
        self.words.append([])
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _edge(self, state: int, word: int, to: int) -> None:
        key = state * self.size + word
        if key not in self.edges:
            self.words[state].append(word)
        self.edges[key] = to

    def _split(self, state: int, word: int, to: int) -> int:
        """The state of the longest string that is one word after ``state``: ``to``, or a copy of it."""
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._state(self.length[state] + 1, self.link[to])
        for w in self.words[to]:
            self._edge(copy, w, self.edges[to * self.size + w])
        self.link[to] = copy
        while self.edges.get(state * self.size + word) == to:
            self.edges[state * self.size + word] = copy
            if not state:
                break
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        to = self.edges.get(last * self.size + word)
        if to is not None:
            return self._split(last, word, to)
        new = self._state(self.length[last] + 1, 0)
        at = last
        while True:
            to = self.edges.get(at * self.size + word)
            if to is not None:
                self.link[new] = self._split(at, word, to)
                return new
            self._edge(at, word, new)
            if not at:
                return new
            at = self.link[at]

    def _name_windows(self, texts: list[list[int]]) -> None:
        """``anchor``: the state that holds the last ``window`` words of a longer match; ``held``: the
        items of its window; ``short``: (words, items) of the whole short items that end a state."""
        n = len(self.length)
        self.anchor = [0] * n
        order = sorted(range(n), key=self.length.__getitem__)
        for v in order:
            if self.length[v] >= self.window:
                up = self.link[v]
                self.anchor[v] = v if self.length[up] < self.window else self.anchor[up]
        held: dict[int, set[int]] = {}
        whole: dict[int, dict[int, set[int]]] = {}
        for item, text in enumerate(texts):
            v = 0
            for i, word in enumerate(text):
                v = self.edges[v * self.size + word]
                if i + 1 >= self.window:
                    held.setdefault(self.anchor[v], set()).add(item)
            if len(text) < self.window:
                whole.setdefault(v, {}).setdefault(len(text), set()).add(item)
        self.held = held
        self.short: dict[int, list[tuple[int, set[int]]]] = {}
        if whole:
            for v in order[1:]:
                own = sorted(whole.get(v, {}).items(), reverse=True) + self.short.get(self.link[v], [])
                if own:
                    self.short[v] = own

    def read(self, words: list[int], at: int, spans: list[list[int]], found: set[int]) -> int:
        """Reads a stretch of item words from the place ``at`` on; adds hit spans and items, and
        returns the longest match."""
        edges, link, length, size, window, short, anchor = self.edges, self.link, self.length, self.size, self.window, self.short, self.anchor
        v = n = longest = 0
        seen: set[int] = set()
        for i, word in enumerate(words, at + 1):
            to = edges.get(v * size + word)
            while to is None:
                v = link[v]
                n = length[v]
                to = edges.get(v * size + word)
            v, n = to, n + 1
            longest = max(longest, n)
            hit = 0
            if n >= window:
                hit = n
                seen.add(anchor[v])
            if v in short:
                for k, items in short[v]:
                    if k <= n:
                        hit = max(hit, k)
                        found |= items
            if hit:
                start = i - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i])
        for state in seen:
            found |= self.held[state]
        return longest

    def scan(self, texts: list[str | None]) -> tuple[list[int], list[int], list[list[list[int]]], list[set[int]]]:
        """Words, longest match (0 if below the shortest window), hit spans in words and items of each text."""
        parts = [text_words(t) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        total = int(sizes.sum())
        ids = np.fromiter(map(self.number.get, chain.from_iterable(parts), repeat(-1)), np.int64, total)
        del parts
        spans: list[list[list[int]]] = [[] for _ in texts]
        found: list[set[int]] = [set() for _ in texts]
        longest = [0] * len(texts)
        if total and self.number:
            begins = np.cumsum(sizes) - sizes
            known = ids >= 0
            joined = np.zeros(total, bool)
            joined[1:] = known[1:] & known[:-1]
            joined[begins[sizes > 0]] = False
            both = np.flatnonzero(joined)
            joined[both] = self.pairs[self._pair_place(ids[both - 1] * self.size + ids[both])]
            breaks = np.flatnonzero(~joined)
            ends = np.append(breaks[1:], total)
            keep = known[breaks] & (ends - breaks >= self.shortest)
            starts, ends = breaks[keep], ends[keep]
            owner = np.searchsorted(begins, starts, "right") - 1
            for a, b, doc in zip(starts.tolist(), ends.tolist(), owner.tolist(), strict=True):
                longest[doc] = max(longest[doc], self.read(ids[a:b].tolist(), a - int(begins[doc]), spans[doc], found[doc]))
        return sizes.tolist(), longest, spans, found


@lru_cache(maxsize=2)
def automaton(items: tuple[Item, ...], window: int) -> SuffixAutomaton:
    return SuffixAutomaton(items, window)


def union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(a + b):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _scanned(rows: DataFrame, at: int, items: tuple[Item, ...], window: int) -> DataFrame:
    """One pass: what a block finds joins what ``rows`` holds in its last four columns already."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    new = _parse_datatype_string(FOUND)
    kept = len(rows.columns) - len(new)
    schema = StructType([*rows.schema.fields[:kept], *(StructField(f.name, f.dataType) for f in new)])
    types = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(items, window)
        for batch in batches:
            before = {f.name: batch.column(kept + i).to_pylist() for i, f in enumerate(new)}
            begin = 0
            for piece in sliced(iter([{"text": batch.column(at).to_pylist()}]), "text", SLICE_CHARS):
                n = len(piece["text"])
                sizes, longest, spans, found = made.scan(piece["text"])
                out = {"n_words": sizes, "longest": longest, "spans": [], "items": []}
                for i in range(n):
                    j = begin + i
                    out["longest"][i] = max(longest[i], before["longest"][j])
                    held = [[s["start"], s["end"]] for s in before["spans"][j]]
                    out["spans"].append([{"start": s, "end": e} for s, e in (union(held, spans[i]) if held else spans[i])])
                    out["items"].append(sorted({*before["items"][j], *(made.names[x] for x in found[i] if made.names[x] is not None)}))
                arrays = [*batch.slice(begin, n).columns[:kept], *(pa.array(out[f.name], type=f.type) for f in types)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                begin += n

    return rows.mapInArrow(run, schema)


def scanned(docs: DataFrame, items: DataFrame, rules: LeakRules, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """``docs`` with its columns renamed to c0, c1, ... and the columns ``FOUND``."""
    at = docs.columns.index(text_col)
    nothing = [F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("longest"),
               F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.array().cast("array<string>").alias("items")]
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    rows = flat.select("*", *nothing)
    done = 0
    for block in item_blocks(items, item_col, item_text, rules.block_chars):
        if done and done % CHAIN == 0:
            rows = written(rows, "scanned")
        rows = _scanned(rows, at, tuple(block), rules.window)
        done += 1
    return rows if done else _scanned(rows, at, (), rules.window)


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contamination(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit`` (words in hit spans), ``longest`` (words of
    the longest match, 0 below the shortest window), ``spans`` (hit words, end exclusive), ``items``
    (ids as strings, sorted by code points)."""
    rows = scanned(docs.select(id_col, text_col), items, rules, id_col, text_col, item_col, item_text)
    return rows.select(F.col("c0").alias(id_col), "n_words", n_hit().alias("n_hit"), "longest", "spans", "items")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters from the first to the last word of each span."""
    places = [m.span() for m in re.finditer(WORD_PATTERN, text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join(out) + text[at:]


def decontaminate(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without leaked spans of over ``max_span`` words, and without
    the rows of which over ``max_covered`` of the words are hit."""
    names, at = docs.columns, f"c{docs.columns.index(text_col)}"
    rows = scanned(docs, items, rules, names[0], text_col, item_col, item_text)
    rows = rows.filter(n_hit() <= F.lit(rules.max_covered) * F.col("n_words"))
    rows = rows.withColumn("spans", F.filter("spans", lambda s: s["end"] - s["start"] > rules.max_span)).drop("n_words", "longest", "items")
    where, schema = int(at[1:]), StructType([f for f in rows.schema if f.name != "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(names)).to_pylist()
            arrays = batch.columns[: len(names)]
            if any(spans):
                texts = arrays[where].to_pylist()
                texts = [cut(t, [(s["start"], s["end"]) for s in of]) if of else t for t, of in zip(texts, spans, strict=True)]
                arrays[where] = pa.array(texts, type=arrays[where].type)
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*names)
