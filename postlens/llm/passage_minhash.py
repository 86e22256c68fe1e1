"""Substring dedup: paragraph MinHash banding.

Passages are glued into longer lines or run over many short ones, so a paragraph here is a piece of
a text's words, whatever its line ends: texts are cut at content-defined places (a word pair whose
hash is the least within ``spread`` words to either side), which fall alike wherever the same
passage stands. Steps:

1. Each paragraph gets ``bands`` MinHash keys over its five-word shingles (a band of one row: at 0.8
   similarity two paragraphs share a key with probability 1 - 0.2^bands). Keys are counted with
   map-side sums; only paragraphs with a key that occurs twice go on.
2. Those paragraphs are made again from their texts, with their shingle sets. Equal ones are one
   node. Different ones that share a key are compared by exact Jaccard, in blocks (``blocks``).
3. Links join into clusters by components. In each document, neighbouring paragraphs of clusters
   with two or more occurrences, in one document or several, make a part if their first occurrences,
   by document and place, are neighbours too.
4. Each part grows word by word to both sides against its first occurrence, whose words on both sides
   come with it, also beyond edits, and on through wider stretches until a difference or the next part
   ends it. Runs of one first document with edits between them are one passage
   if the whole of it has the similarity, by exact Jaccard of the aligned shingles. What then has ``min_words`` or more is a removal; the first occurrences stay.

Hot keys (a passage in a third of all documents) meet only map-side sums and joins between tables,
which adaptive execution splits. No step emits pairs of occurrences.

Defined cases: null, empty or short texts have no paragraphs; rows of the same id and text count as
one document; null ids take part last in order; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import forest, in_blocks, runs
from .components import components
from .store import appended, map_columns, sliced, written, written_side

SLICE_CHARS = 4_000_000
#: Words beside a matched part that are compared first. Where the texts still agree less than
#: ``AHEAD`` words before their end, the part is compared again with ``WIDER`` times as many.
REACH, AHEAD, WIDER = 48, 24, 16
MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class PassageRules:
    """``similarity`` and ``recall`` tune the bands; ``words``: shingle length; ``spread``: words to
    either side within which a cut's hash is the least; ``min_words``: shortest passage that counts."""

    similarity: float = 0.8
    recall: float = 0.95
    words: int = 5
    spread: int = 5
    min_words: int = 18

    @property
    def bands(self) -> int:
        """The fewest bands of one row that reach the recall at the similarity."""
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - self.similarity)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of ``x`` moves every bit of the result."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Paragraphs:
    """The paragraphs of many texts. ``hashes``: of all words; ``start`` and ``size``: each
    paragraph's place there; ``doc``: its text; ``place``: its first word's number in that text."""

    hashes: np.ndarray
    start: np.ndarray
    size: np.ndarray
    doc: np.ndarray
    place: np.ndarray

    def shingles(self, words: int) -> np.ndarray:
        """The hash of the shingle that begins at each word; MAX where it leaves its paragraph."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        for k in range(min(words, n)):
            out[: n - k] = mixed(out[: n - k] + self.hashes[k:])
        end = np.repeat(self.start + self.size, self.size)
        out[np.arange(n) + words > end] = MAX
        return out

    def keys(self, shingles: np.ndarray, bands: int) -> list[np.ndarray]:
        made = []
        for band in range(bands):
            order = mixed(shingles + np.uint64(band + 1))
            order[shingles == MAX] = MAX
            made.append(np.minimum.reduceat(order, self.start))
        return made

    def content(self) -> np.ndarray:
        """A hash of each paragraph's words in order."""
        inside = np.arange(len(self.hashes)) - np.repeat(self.start, self.size)
        return np.add.reduceat(mixed(self.hashes + inside.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), self.start)


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all ``texts``, and how many each text has. The words are told apart
    first, so that each is hashed once."""
    import pyarrow.compute as pc
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string())))
    words = lists.flatten().dictionary_encode()
    known = [w.encode() for w in words.dictionary.to_numpy(zero_copy_only=False)]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    which, ends = words.indices.to_numpy(), lists.offsets.to_numpy()
    empty = known.index(b"") if b"" in known else -1  # beside white space at a text's ends
    real = which != empty
    return h[which[real]], np.diff(np.append(0, np.cumsum(real))[ends])


def paragraphs(texts: list[str | None], rules: PassageRules) -> Paragraphs | None:
    """The paragraphs of at least ``words`` words; None if the texts have no words."""
    h, size = hashed_words(texts)
    if not len(h):
        return None
    doc = np.flatnonzero(size)
    size = size[doc]
    n, text_start = len(h), np.cumsum(size) - size
    pair = h.copy()
    pair[:-1] += mixed(h[1:])
    pair = mixed(pair)
    at = np.arange(n)
    first, last = np.repeat(text_start, size), np.repeat(text_start + size, size)
    w = rules.spread
    cut = (at - w >= first) & (at + w < last)
    for k in range(1, min(w, n - 1) + 1):
        cut[k:] &= pair[k:] < pair[:-k]
        cut[:-k] &= pair[:-k] <= pair[k:]
    cut[text_start] = True
    start = np.flatnonzero(cut)
    lengths = np.diff(np.append(start, n))
    of = np.repeat(doc, size)[start]
    doc_start = np.zeros(len(texts), np.int64)
    total = np.bincount(doc, size, len(texts)).astype(np.int64)
    doc_start[:] = np.cumsum(total) - total
    return Paragraphs(h, start, lengths, of, start - doc_start[of])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def band_keys(docs: DataFrame, rules: PassageRules) -> DataFrame:
    """(key, doc_id, tag, place): ``docs`` is (doc_id, tag, text)."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in sliced(batches, "text", SLICE_CHARS):
            made = paragraphs(batch["text"], rules)
            if made is None:
                continue
            keys = made.keys(made.shingles(rules.words), rules.bands)
            long = np.flatnonzero(made.size >= rules.words)
            of, place = pa.array(made.doc[long]), made.place[long]
            row_ids, row_tags = (pa.array(batch[c], pa.int64()).take(of) for c in ("doc_id", "tag"))
            for key in keys:
                yield {"key": signed(key[long]), "doc_id": row_ids, "tag": row_tags, "place": place}

    return map_columns(docs, run, "key long, doc_id long, tag int, place int")


def shingle_sets(shingles: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.ListArray:
    """The distinct ``shingles`` of each stretch of ``count`` from ``start``, ascending."""
    first, own = np.cumsum(count) - count, np.repeat(np.arange(len(start)), count)
    values = shingles[np.arange(len(own)) + np.repeat(start - first, count)]
    order = np.lexsort((values, own))
    values = values[order]
    new = np.ones(len(values), bool)  # sorting moves nothing from one stretch to another
    new[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    sizes = np.bincount(own[new], minlength=len(start))
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), values[new])


def candidate_paragraphs(docs: DataFrame, rules: PassageRules) -> DataFrame:
    """(doc_id, tag, place, size, content, keys, shingles) of paragraphs with a key that occurs twice.
    Rows of equal id and text come more than once."""
    keyed = band_keys(docs, rules)
    shared = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "shared-keys")
    places = keyed.join(shared.hint("shuffle_hash"), "key").groupBy("doc_id", "tag").agg(F.collect_set("place").alias("places"))
    met = docs.withColumnsRenamed({"doc_id": "d", "tag": "t"}).join(places.hint("shuffle_hash"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tag")))
    met = met.select("doc_id", "tag", "places", "text")

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in sliced(batches, "text", SLICE_CHARS):
            made = paragraphs(batch["text"], rules)
            if made is None:
                continue
            shingles, content = made.shingles(rules.words), signed(made.content())
            keys = np.stack([signed(k) for k in made.keys(shingles, rules.bands)], axis=1)
            sizes = [len(p) for p in batch["places"]]
            wanted = (np.repeat(np.arange(len(sizes)), sizes) << 32) + np.array([x for p in batch["places"] for x in p], np.int64)
            at = np.flatnonzero((made.size >= rules.words) & np.isin((made.doc << 32) + made.place, wanted))
            of = pa.array(made.doc[at])
            yield {
                "doc_id": pa.array(batch["doc_id"], pa.int64()).take(of), "tag": pa.array(batch["tag"], pa.int64()).take(of),
                "place": made.place[at], "size": made.size[at], "content": content[at],
                "keys": pa.ListArray.from_arrays((np.arange(len(at) + 1) * rules.bands).astype(np.int32), keys[at].ravel()),
                "shingles": shingle_sets(signed(shingles), made.start[at], made.size[at] - rules.words + 1),
            }

    return map_columns(met, run, "doc_id long, tag int, place int, size int, content long, keys array<long>, shingles array<long>")


#: Groups of up to so many sets are compared as Python sets, larger ones by an inverted index.
FEW = 48


def similar_sets(sets: list[list[int]], least: float) -> list[tuple[int, int]]:
    """Spanning-forest edges (``blocks.forest``) of the sets with an exact Jaccard of ``least``."""
    counts = np.array([len(s) for s in sets])
    if len(sets) <= FEW:
        held, sizes = [frozenset(s) for s in sets], counts.tolist()

        def near(i: int, rest: np.ndarray) -> np.ndarray:
            out = []
            for r in rest.tolist():
                both = len(held[i] & held[r])
                out.append(both >= least * (sizes[i] + sizes[r] - both) - 1e-9)
            return np.array(out)

        return forest(len(sets), near)
    _, flat = np.unique(np.concatenate([np.array(s, np.int64) for s in sets]), return_inverse=True)
    ends = np.cumsum(counts)
    order = np.argsort(flat, kind="stable")
    member = np.repeat(np.arange(len(sets)), counts)[order]
    upto = np.cumsum(np.bincount(flat))

    def near_by_index(i: int, rest: np.ndarray) -> np.ndarray:
        own = flat[ends[i] - counts[i] : ends[i]].tolist()
        met = np.concatenate([member[upto[s - 1] if s else 0 : upto[s]] for s in own])
        both = np.bincount(met, minlength=len(sets))[rest]
        return both >= least * (counts[rest] + counts[i] - both) - 1e-9

    return forest(len(sets), near_by_index)


def similar(found: DataFrame, nodes: DataFrame, rules: PassageRules) -> DataFrame:
    """Links (a, b) between different paragraphs that share a key and have the similarity, as spanning
    forests. ``nodes``: the distinct (content, keys); only those that share a key with another one
    get their shingles from ``found``."""
    keyed = nodes.select("content", F.explode("keys").alias("key")).distinct()
    sizes = written_side(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "key-sizes")
    met = written(keyed.join(sizes, "key"), "key-members")
    asked = written_side(met.select("content").distinct(), "compared")
    sets = found.select("content", "shingles").join(asked, "content").dropDuplicates(["content"])
    dealt = in_blocks(met.join(sets, "content"), "n", F.xxhash64("content")).drop("n")
    by = ["key", "pair"]

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for group in runs(batches, by):
            if len(group["shingles"]) < 2:
                continue
            edges = similar_sets(group["shingles"], rules.similarity)
            yield {"a": [group["content"][x] for x, _ in edges], "b": [group["content"][y] for _, y in edges]}

    return map_columns(dealt.repartition(*by).sortWithinPartitions(*by), run, "a long, b long")


def repeated_passages(docs: DataFrame, rules: PassageRules = PassageRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and repeated passage, or part of one that stays or goes: (doc_id, tag, first_word, n_words, cluster_id,
    first_doc_id, removed). Words are numbered from 0 in the text; ``first_doc_id`` is the document
    whose occurrence stays; ``cluster_id`` is the same for all occurrences of a first paragraph."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(text_col).alias("tag"), F.col(text_col).alias("text"))
    found = written(candidate_paragraphs(rows, rules), "paragraphs")
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag", "place", "size", "content")
    nodes = found.groupBy("content", "keys").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    nodes = written(nodes, "paragraph-nodes")
    roots = components(similar(found, nodes.select("content", "keys"), rules))
    rooted = nodes.drop("keys").join(roots.select(F.col("node").alias("content"), "root"), "content", "left").withColumn("root", F.coalesce("root", "content"))
    rooted = written(rooted, "paragraph-roots")
    spans = rooted.groupBy("root").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    again = written(spans.filter(~F.col("low").eqNullSafe(F.col("high"))).select("root", "low"), "paragraph-clusters")
    of = written(rooted.select("content", "root").join(again, "root"), "paragraph-members")
    members = found.select("doc_id", "tag", "place", "size", "content").join(of.hint("shuffle_hash"), "content")
    own = F.col("low.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("low.tag") == F.col("tag")) & (F.col("low.place") == F.col("place"))
    by_doc = Window.partitionBy("doc_id", "tag").orderBy("place")
    copies = members.filter(~own).withColumn("same", F.lag("place").over(by_doc) == F.col("place")).filter("same is null or not same")
    source = F.struct("low.no_id", "low.doc_id", "low.tag")
    upto = F.col("low.place") + F.col("low.size")
    item = lambda start, end, at, upto: F.struct(start.alias("start"), end.alias("end"), at.alias("at"), upto.alias("upto"))
    start, end, at = F.col("place"), F.col("place") + F.col("size"), F.col("low.place")
    ends = F.array(item(start, start, at, at), item(end, end, upto, upto))  # of a similar paragraph only the ends are taken, to grow from
    copies = copies.withColumn("piece", F.explode(F.when(F.col("content") == F.col("low.content"), F.array(item(start, end, at, upto))).otherwise(ends)))
    copies = copies.select("doc_id", "tag", "root", source.alias("source"), "piece.*")
    by_doc = Window.partitionBy("doc_id", "tag").orderBy("start", "end")
    on = (F.lag("end").over(by_doc) == F.col("start")) & F.lag("source").over(by_doc).eqNullSafe(F.col("source")) & (F.lag("upto").over(by_doc) == F.col("at"))
    chained = copies.withColumn("run", F.sum((~F.coalesce(on, F.lit(False))).cast("int")).over(by_doc))
    parts = chained.groupBy("doc_id", "tag", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("root", "start").alias("root"),
        F.min("source").alias("source"), F.min("at").alias("at"), F.max("upto").alias("upto"),
    )
    parts = written(parts.select("doc_id", "tag", "start", "end", "root", "source.*", "at", "upto").toDF("doc_id", "tag", "start", "end", "root", "no_id", "s_doc", "s_tag", "at", "upto"), "passage-parts")
    return joined_passages(grown_passages(rows, parts, rules))


def grown_passages(docs: DataFrame, parts: DataFrame, rules: PassageRules) -> DataFrame:
    """``aligned_passages`` of all ``parts``. Documents with parts that agree up to the end of what was
    compared come again, with a wider reach of those parts, until none is left; a reach ends with its text."""
    todo, done, reach, again = parts.withColumn("reach", F.lit(REACH)), None, REACH, docs
    while True:
        made = written(aligned_passages(again, todo, surroundings(docs, todo), rules), "passage-spans")
        spans = made.filter("removed is not null")
        done = spans if done is None else done.unionByName(spans)
        more = made.filter("removed is null").select(*[F.col(c).alias(f"m_{c}") for c in ("doc_id", "tag", "start", "end")]).distinct()
        if more.isEmpty():
            return done
        reach *= WIDER
        of = F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & (F.col("tag") == F.col("m_tag"))
        here = (F.col("start") == F.col("m_start")) & (F.col("end") == F.col("m_end"))
        held = todo.join(more.select("m_doc_id", "m_tag").distinct(), of, "left_semi")
        held = held.join(more, of & here, "left").withColumn("reach", F.when(F.col("m_start").isNull(), F.col("reach")).otherwise(F.lit(reach)))
        todo = written(held.drop("m_doc_id", "m_tag", "m_start", "m_end"), "passage-parts")
        ids = written_side(todo.select(F.col("doc_id").alias("m_doc_id"), F.col("tag").alias("m_tag")).distinct(), "passage-open", hashed=True)
        again = docs.join(ids, of, "left_semi")


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """32 bits of the hash of each word of each text."""
    h, sizes = hashed_words(texts)
    return np.split(h.astype(np.uint32).view(np.int32), np.cumsum(sizes)[:-1])


def surroundings(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """(s_doc, s_tag, at, upto, reach, before, after): the hashes of the ``reach`` words on both sides of
    each first occurrence that ``parts`` name, once each, as 32-bit integers. The passage itself is never sent."""
    asked = parts.groupBy("s_doc", "s_tag").agg(F.collect_set(F.struct("at", "upto", "reach")).alias("asked"))
    asked = written_side(asked, "passage-sources", hashed=True)
    met = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("tag") == F.col("s_tag"))).select("s_doc", "s_tag", "asked", "text")

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in sliced(batches, "text", SLICE_CHARS):
            out = {k: [] for k in ("s_doc", "s_tag", "at", "upto", "reach", "before", "after")}
            for doc, tag, spans, h in zip(batch["s_doc"], batch["s_tag"], batch["asked"], word_hashes(batch["text"]), strict=True):
                for span in spans:
                    at, upto, reach = span["at"], span["upto"], span["reach"]
                    for k, v in zip(out, (doc, tag, at, upto, reach, h[max(0, at - reach) : at].tobytes(), h[upto : upto + reach].tobytes()), strict=True):
                        out[k].append(v)
            yield out

    made = map_columns(met, run, "s_doc long, s_tag int, at int, upto int, reach int, before binary, after binary")
    return written_side(made.dropDuplicates(["s_doc", "s_tag", "at", "upto", "reach"]), "passage-surroundings", hashed=True)


def steps(x: list[int], y: list[int], words: int) -> list[tuple[int, int, int]]:
    """The aligned runs (place in x, place in y, words) from the beginnings of ``x`` and ``y``. Behind a
    difference they go on at the nearest places from which ``words`` words agree. The places in ``y`` are
    noted once, and a search ends where no nearer one can follow, so the time is in proportion to the words."""
    out, i, j = [], 0, 0
    places: dict[tuple, list[int]] | None = None
    while True:
        n, most = 0, min(len(x) - i, len(y) - j)
        while n < most and x[i + n] == y[j + n]:
            n += 1
        if n:
            out.append((i, j, n))
        i, j = i + n, j + n
        if places is None:
            known = set(y[j:])
            if bytes([w in known for w in x[i:]]).find(b"\x01" * words) < 0:  # no such place
                return out
            places = {}
            for k, shingle in enumerate(zip(*(y[j + w :] for w in range(words)), strict=False), j):
                places.setdefault(shingle, []).append(k)
            shingles, begin = list(zip(*(x[i + w :] for w in range(words)), strict=False)), i
        best = None
        for k in range(len(shingles) + begin - i):
            if best and k >= best[0]:
                break
            met = places.get(shingles[k + i - begin])
            if met and met[-1] >= j:
                m = met[bisect_left(met, j)] - j
                if best is None or (k + m, k, m) < best:
                    best = (k + m, k, m)
        if best is None:
            return out
        i, j = i + best[1], j + best[2]


@dataclass
class Run:
    """Words ``start`` to ``end`` of a text that stand, but for edits, at ``at`` to ``upto`` of the
    source; ``less``: by how much fewer shingles than words they share."""

    start: int
    end: int
    at: int
    upto: int
    root: int
    less: int = 0


def unfinished(runs: list[tuple[int, int, int]], x: int, y: int, reach: int) -> bool:
    """Whether the aligned ``runs`` of stretches of ``x`` and ``y`` words may go on behind them: both texts
    have more words there, and fewer than ``AHEAD`` were left to be compared."""
    if not runs:
        return False
    i, j, n = runs[-1]
    left = [(size - at - n, size == reach) for size, at in ((x, i), (y, j))]
    return all(rest or cut for rest, cut in left) and any(rest < AHEAD and cut for rest, cut in left)


def grown(h: np.ndarray, part: dict, words: int, room: tuple[int, int]) -> tuple[list[Run], bool]:
    """The part of the text with word hashes ``h``, the runs by which it goes on to both sides, and
    whether they may go on beyond its reach. ``room``: the ends of the nearest other parts, which grow themselves."""
    start, end, at, upto, root, reach = (part[k] for k in ("start", "end", "at", "upto", "root", "reach"))
    runs = [Run(start, end, at, upto, root)]
    before, after = (np.frombuffer(part[k], np.int32) for k in ("before", "after"))
    x, y = h[max(0, start - reach) : start][::-1].tolist(), before[::-1].tolist()
    left = steps(x, y, words)
    more = unfinished(left, len(x), len(y), reach) and start - left[-1][0] - left[-1][2] > room[0]
    runs += [Run(start - i - n, start - i, at - j - n, at - j, root) for i, j, n in left]
    x, y = h[end : end + reach].tolist(), after.tolist()
    right = steps(x, y, words)
    more = more or (unfinished(right, len(x), len(y), reach) and end + right[-1][0] + right[-1][2] < room[1])
    runs += [Run(end + i, end + i + n, upto + j, upto + j + n, root) for i, j, n in right]
    return [r for r in runs if r.end > r.start], more


def fused(runs: list[Run]) -> list[Run]:
    """``runs`` of one source, those that meet or overlap on one diagonal as one, by place."""
    out: list[Run] = []
    for run in sorted(runs, key=lambda r: (r.at - r.start, r.start, r.end)):
        last = out[-1] if out else None
        if last and last.upto - last.end == run.at - run.start and run.start <= last.end:
            if run.end > last.end:
                last.end, last.upto = run.end, run.upto
        else:
            out.append(run)
    return sorted(out, key=lambda r: (r.start, r.end))


def bridged(runs: list[Run], own: bool, rules: PassageRules) -> list[Run]:
    """``runs`` by place, neighbours as one passage with the edit between them if the whole is similar:
    exact Jaccard of the aligned shingles. ``own``: the source is the same text, and has to end before."""
    over = rules.words - 1

    def joined(u: Run, v: Run) -> Run | None:
        i, j = v.start - u.end, v.at - u.upto
        if i < 0 or j < 0 or (own and v.upto > u.start):
            return None
        less = u.less + v.less + over + i  # the shingles that touch the edit or lie beside it
        both = v.end - u.start - over - less
        either = (v.end - u.start - over) + (v.upto - u.at - over) - both
        return Run(u.start, v.end, u.at, v.upto, u.root, less) if both >= rules.similarity * either - 1e-9 else None

    while True:
        out: list[Run] = []
        for run in runs:
            made = joined(out[-1], run) if out else None
            if made:
                out[-1] = made
            else:
                out.append(run)
        if len(out) == len(runs):
            return out
        runs = out


def aligned_passages(docs: DataFrame, parts: DataFrame, sides: DataFrame, rules: PassageRules) -> DataFrame:
    """(doc_id, tag, start, end, cluster_id, first_doc_id, removed): the parts grown word by word against
    their first occurrences; those of ``min_words`` or more, and the first occurrences they were held against.
    Of a document with parts that may go on beyond their reach only these parts, ``removed`` null."""
    by = F.col("s_doc").eqNullSafe(F.col("d")) & (F.col("s_tag") == F.col("t")) & (F.col("at") == F.col("a")) & (F.col("upto") == F.col("u")) & (F.col("reach") == F.col("r"))
    known = parts.join(sides.withColumnsRenamed({"s_doc": "d", "s_tag": "t", "at": "a", "upto": "u", "reach": "r"}), by)
    item = F.struct("start", "end", "root", "no_id", "s_doc", "s_tag", "at", "upto", "reach", "before", "after")
    held = written_side(known.groupBy("doc_id", "tag").agg(F.collect_list(item).alias("parts")).withColumnsRenamed({"doc_id": "d", "tag": "t"}), "passage-alignments", hashed=True)
    met = docs.join(held, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t"))).select("doc_id", "tag", "parts", "text")

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in sliced(batches, "text", SLICE_CHARS):
            out = {k: [] for k in ("doc_id", "tag", "start", "end", "cluster_id", "first_doc_id", "removed")}
            for doc, tag, found, h in zip(batch["doc_id"], batch["tag"], batch["parts"], word_hashes(batch["text"]), strict=True):
                sources, open_parts = {}, []
                found.sort(key=lambda p: (p["start"], p["end"]))
                ends = [0, *accumulate((p["end"] for p in found), max)]
                starts = [*(p["start"] for p in found[1:]), len(h)]
                for k, part in enumerate(found):
                    own, more = grown(h, part, rules.words, (ends[k], starts[k]))
                    sources.setdefault((part["no_id"], part["s_doc"], part["s_tag"]), []).extend(own)
                    if more:
                        open_parts.append(part)
                if open_parts:
                    for part in open_parts:
                        for k, v in zip(out, (doc, tag, part["start"], part["end"], None, None, None), strict=True):
                            out[k].append(v)
                    continue
                spans = sorted(((r.start, r.end, r, s) for s, runs in sources.items() for r in bridged(fused(runs), s[2] == tag and s[1] == doc, rules)), key=lambda x: x[:2])
                made = []
                for start, end, r, s in spans:
                    if made and start <= made[-1][1]:
                        made[-1][1] = max(made[-1][1], end)
                        made[-1][2].append((r, s))
                    else:
                        made.append([start, end, [(r, s)]])
                for start, end, held in made:
                    if end - start < rules.min_words:
                        continue
                    first = min((s for _, s in held), key=lambda s: (s[0], s[1] or 0))[1]
                    rows = [(doc, tag, start, end, held[0][0].root, first, True)]
                    rows += [(s[1], s[2], r.at, r.upto, r.root, s[1], False) for r, s in held]
                    for row in rows:
                        for k, v in zip(out, row, strict=True):
                            out[k].append(v)
            yield out

    return map_columns(met, run, "doc_id long, tag int, start int, end int, cluster_id long, first_doc_id long, removed boolean")


def joined_passages(spans: DataFrame) -> DataFrame:
    """Removals as they are; first occurrences joined where they overlap, without words that go."""
    by = ["doc_id", "tag"]
    once = spans.groupBy(*by, "removed", "start").agg(F.max(F.struct("end", "cluster_id", "first_doc_id")).alias("x")).select(*by, "removed", "start", "x.*")
    sort = [*by, F.desc("removed"), "start"]

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for group in runs(batches, by):
            rows = list(zip(*(group[k] for k in ("start", "end", "cluster_id", "first_doc_id", "removed")), strict=True))
            gone, kept = [r for r in rows if r[4]], []
            upto, k = 0, 0
            for start, end, cluster, first, _ in (r for r in rows if not r[4]):
                start = max(start, upto)
                upto = max(upto, end)
                while start < end:
                    while k < len(gone) and gone[k][1] <= start:
                        k += 1
                    until = min(end, gone[k][0]) if k < len(gone) else end
                    if until > start:
                        if kept and kept[-1][1] == start:
                            kept[-1] = (kept[-1][0], until, *kept[-1][2:])
                        else:
                            kept.append((start, until, cluster, first, False))
                    start = max(until, gone[k][1]) if k < len(gone) and until < end else end
            rows = gone + kept
            yield {
                "doc_id": [group["doc_id"][0]] * len(rows), "tag": [group["tag"][0]] * len(rows), "first_word": [r[0] for r in rows], "n_words": [r[1] - r[0] for r in rows],
                "cluster_id": [r[2] for r in rows], "first_doc_id": [r[3] for r in rows], "removed": [r[4] for r in rows],
            }

    schema = "doc_id long, tag int, first_word int, n_words long, cluster_id long, first_doc_id long, removed boolean"
    return map_columns(once.repartition(*by).sortWithinPartitions(*sort), run, schema)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (first, number) and the white space after them."""
    import re

    starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    out, upto = [], 0
    for first, n in sorted(spans):
        a, b = starts[first], starts[min(first + n, len(starts) - 1)]
        if b > upto:
            out.append(text[upto : max(a, upto)])
            upto = b
    return "".join(out) + text[upto:]


def remove_passages(docs: DataFrame, rules: PassageRules = PassageRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all rows and columns, without the removed passages in ``text_col``."""
    spans = repeated_passages(docs, rules, id_col, text_col).filter("removed")
    edits = written_side(spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first_word", "n_words")).alias("spans")), "passage-edits")
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    by, at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    edits = edits.withColumnsRenamed({"doc_id": "__id", "tag": "__tag", "spans": "__spans"})
    met = flat.join(edits, F.col(by).eqNullSafe(F.col("__id")) & (F.hash(at) == F.col("__tag")), "left")
    both = met.withColumn("both", F.when(F.col("__spans").isNotNull(), F.struct(F.col(at).alias("text"), F.col("__spans").alias("spans")))).drop("__id", "__tag", "__spans")

    def many(rows: list) -> dict:
        return {"cut": [None if r is None else cut_words(r["text"], [(s["first_word"], s["n_words"]) for s in r["spans"]]) for r in rows]}

    done = appended(both, "both", many, "cut string", 1 << 30)
    text = F.coalesce("cut", at)
    return done.withColumn(at, text).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
