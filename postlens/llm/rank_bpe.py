"""BPE encoding and decoding with a contiguous rank array.

A word's parts and the ranks of its adjacent pairs lie in two short contiguous rows. The least rank
is found by a scan; its boundary is deleted and the two neighbouring ranks are refreshed. The new
words of a slice of texts take these steps side by side, as rows of one matrix. Words beyond
``SHORT`` parts take the same merges from a heap over linked parts, so that a very long word costs
n log n. Distinct chunks are encoded once per Python worker (bounded table).

``encode`` and ``decode`` are narrow: one pass each, no shuffle, memory bounded by a slice of
texts. Defined cases: a null or empty text has no ids and decodes to an empty text; null arrays
decode to an empty text; rows pass one by one, so repeated rows and null ids stay; an empty table
gives an empty result; other columns pass through unread, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memo import byte_letters, char_class, lowered
from .store import appended

SHORT = 32
#: Marks that the splitting pattern cuts off a run of letters, as a part of their own.
CLOSING = ".,;:!?"
#: The table of chunks becomes the old one beyond so many; a slice's chunks come on top. Longer chunks
#: (text without white space, say) are kept for their slice only, so the table's characters are bounded.
MOST_CHUNKS = 250_000
LONGEST_CHUNK = 64
#: Unicode's White_Space property.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SLICE_CHARS = 1_500_000


class RankBpe:
    """A vocabulary of the tokenizers library's file format: byte-level BPE with word ends, texts
    normalised to NFC, single spaces and lower case, split by the file's own pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for major in "LN":  # the library's tables are the standard library's, not those of newer packages
            split = split.replace(rf"\p{{{major}}}", char_class(major))
        self.pattern = re.compile(split.replace("[[", "[").replace("]]", "]").replace(r"\s", WHITE))
        self.space = re.compile(f"[{WHITE}]+")
        self.at_special = re.compile("(" + "|".join(re.escape(t) for t in self.special) + ")")
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        self.ranks: dict[tuple[int, int], int] = {}
        self.made = np.zeros(len(model["merges"]), np.int64)  # by rank: the id that the merge makes
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks.setdefault((vocab[a], vocab[b]), rank)
            self.made[rank] = vocab[a + b]
        self.size = len(self.made)
        pairs = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = np.append(pairs[order], -1), np.append(np.array(list(self.ranks.values()), np.int64)[order], self.size)
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs of parts; ``size`` where there is no merge."""
        key = a << 32 | b
        at = np.searchsorted(self.pairs[:-1], key)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], self.size)

    def merged_rows(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of up to ``SHORT`` bytes, as little-endian unsigned 32-bit integers."""
        lengths = np.array([len(w) for w in words])
        wide = int(lengths.max())
        flat = np.frombuffer(b"".join(words), np.uint8)
        filled = np.arange(wide) < lengths[:, None]
        parts = np.full((len(words), wide), -1, np.int64)
        parts[filled] = self.inner[flat]
        parts[np.arange(len(words)), lengths - 1] = self.last[flat[np.cumsum(lengths) - 1]]
        ranks = np.full((len(words), max(1, wide - 1)), self.size, np.int64)
        if wide > 1:
            pair = filled[:, 1:]
            ranks[pair] = self.rank_of(parts[:, :-1][pair], parts[:, 1:][pair])
        rows = np.arange(len(words))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            more = least < self.size
            done.append((rows[~more], parts[~more]))
            rows, parts, ranks, at, least = rows[more], parts[more], ranks[more], at[more], least[more]
            if not len(rows):
                break
            every = np.arange(len(rows))
            parts[every, at] = self.made[least]
            places = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, places + (places > at[:, None]), axis=1)  # without the part behind
            places = np.arange(max(1, ranks.shape[1] - 1))
            if ranks.shape[1] > 1:
                ranks = np.take_along_axis(ranks, places + (places >= at[:, None]), axis=1)
            else:
                ranks = np.full_like(ranks, self.size)
            for left in (at - 1, at):
                ok = (left >= 0) & (left + 1 < parts.shape[1])
                r, c = every[ok], left[ok]
                a, b = parts[r, c], parts[r, c + 1]
                ranks[r, c] = np.where(b >= 0, self.rank_of(a, np.maximum(b, 0)), self.size)
        out: list[bytes] = [b""] * len(words)
        for rows, parts in done:
            held = parts >= 0
            ends = np.cumsum(held.sum(axis=1)) * 4
            ids, start = parts[held].astype("<u4").tobytes(), 0
            for row, end in zip(rows.tolist(), ends.tolist(), strict=True):
                out[row] = ids[start:end]
                start = end
        return out

    def merged(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words."""
        out, raw = {}, [w.encode() for w in words]
        by_size = sorted(range(len(words)), key=lambda i: len(raw[i]))
        short = [i for i in by_size if len(raw[i]) <= SHORT]
        for a in range(0, len(short), 8192):
            some = short[a : a + 8192]
            out |= zip([words[i] for i in some], self.merged_rows([raw[i] for i in some]), strict=True)
        for i in by_size[len(short) :]:
            parts = [int(self.inner[b]) for b in raw[i][:-1]] + [int(self.last[raw[i][-1]])]
            out[words[i]] = array("I", self.merged_long(parts)).tobytes()
        return out

    def merged_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        nxt, prev, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        rank, none = self.ranks.get, self.size
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]), none)) < none]
        heapq.heapify(heap)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], nxt[i] = int(self.made[least]), False, nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and nxt[k] >= 0 and (r := rank((parts[k], parts[nxt[k]]), none)) < none:
                    heapq.heappush(heap, (r, k, parts[k], parts[nxt[k]]))
        return [p for p, ok in zip(parts, alive, strict=True) if ok]

    def normal(self, text: str) -> str:
        return self.space.sub(" ", lowered(text))

    def words(self, chunk: str) -> list[str | int]:
        """The words of a chunk, and the ids of special tokens in it."""
        body = chunk.rstrip(CLOSING)
        if body.isalpha():
            word = lowered(body)
            if word.isalpha():
                return [word, chunk[len(body) :]] if len(body) < len(chunk) else [word]
        out: list[str | int] = []
        for piece in self.at_special.split(chunk):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += self.pattern.findall(self.normal(piece))
        return out

    def fill(self, chunks: set[str]) -> None:
        """Encodes and decodes the chunks that the tables don't hold."""
        new = [c for c in chunks if c not in self.chunks]
        if len(self.chunks) + len(new) > MOST_CHUNKS:
            self.old, self.chunks = self.chunks, {}
            new = list(chunks)
        again = {c: made for c in new if (made := self.old.get(c)) is not None}
        self.chunks |= again
        split = {c: self.words(c) for c in new if c not in again}
        self.has_long = any(len(c) > LONGEST_CHUNK for c in split)
        ids = self.merged(list({w for words in split.values() for w in words if isinstance(w, str)}))
        for c, words in split.items():
            made = b"".join([ids[w] if isinstance(w, str) else array("I", [w]).tobytes() for w in words])
            self.chunks[c] = made, self.decode(array("I", made).tolist())

    def round_trips(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """The ids of each text, as little-endian unsigned 32-bit integers, and the text that they
        decode to. White space ends words and tokens decode to texts joined by a space, so chunks
        between spaces or line ends are encoded and decoded alone."""
        keys = [t.replace("\n", " ").split(" ") for t in texts]
        self.fill(set().union(*keys))
        out = []
        for chunks in keys:
            ids, decoded = zip(*map(self.chunks.__getitem__, chunks), strict=True)
            out.append((b"".join(ids), " ".join(filter(None, decoded))))
        for c in [c for c in self.chunks if len(c) > LONGEST_CHUNK] if self.has_long else ():
            del self.chunks[c]
        self.has_long = False
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts, joined by one space (the file names no decoder)."""
        return " ".join(map(self.tokens.__getitem__, ids))


@cache
def vocabulary(path: str) -> RankBpe:
    """The vocabulary of this Python process; its tables serve all tasks that the process runs."""
    return RankBpe(path)


def lists(made: list[bytes]):
    """Little-endian unsigned 32-bit integers, a value for each row, as an Arrow array of int lists."""
    import pyarrow as pa

    ends = np.cumsum([0, *(len(m) // 4 for m in made)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), "<i4")))


def others(rows: DataFrame, *names: str) -> list:
    """The columns of ``rows`` but ``names``: an input column that is called like an output is replaced."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns) if c not in names]


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` without ``text_col``, with the ids of its texts as ``out`` (array of int)."""
    rows = appended(docs, text_col, lambda texts: {"ids": lists([ids for ids, _ in vocabulary(path).round_trips([t or "" for t in texts])])}, "ids array<int>", SLICE_CHARS)
    return rows.select(*others(docs, text_col, out), F.col("ids").alias(out))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the texts of ``ids_col`` as ``out``."""
    made = appended(rows, ids_col, lambda ids: {"decoded": list(map(vocabulary(path).decode, (x or [] for x in ids)))}, "decoded string", SLICE_CHARS // 4)
    return made.select(*others(rows, out), F.col("decoded").alias(out))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` without ``text_col``, with the ids and the texts
    that they decode to."""

    def many(texts: list) -> dict:
        made = vocabulary(path).round_trips([t or "" for t in texts])
        return {"ids": lists([m[0] for m in made]), "decoded": [m[1] for m in made]}

    rows = appended(docs, text_col, many, "ids array<int>, decoded string", SLICE_CHARS)
    return rows.select(*others(docs, text_col, ids, out), F.col("ids").alias(ids), F.col("decoded").alias(out))
