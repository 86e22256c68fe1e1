"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. Two that differ in at most ``3`` bits differ in at most one bit of one
32-bit half. In each half the code words of the perfect [31, 26] Hamming code are the anchors: they
cover the space of 31 bits with radius 1, so every fingerprint lies within 1 of an anchor, its home,
and one that differs from it by 1 bit lies within 1 + 1 of that same anchor. Each fingerprint is
replicated to the anchors within 2 of it (1 or 16 a half) and compared per anchor over all 64 bits.
Anchors number 2^26 a half, so few fingerprints meet by chance.

Equal fingerprints are one node from the start, so exact copies cost one row a task. Anchors with
many members are compared in pairs of blocks (``blocks``); links come out as spanning forests and
join into components by contraction (``components``).

Defined cases: a null or wordless text has fingerprint zero, linked like any other; null ids take
part but never name a component unless it has no other id; repeated rows each get a row; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import forest, in_blocks, runs
from .components import components
from .store import appended, map_columns, written, written_side

SEED = 42
SLICE_CHARS = 1_000_000
CODE_BITS = 31
THRESHOLD = 3


def text_fingerprints(texts: list[str | None], words: int = 3) -> list[int]:
    """The fingerprint of each text as a signed 64-bit integer."""
    import xxhash

    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        parts = (text or "").encode().lower().split()
        if len(parts) <= words:
            made = [digest(b" ".join(parts), SEED)] if parts else []
        else:
            joined = b" ".join(parts)
            ends = [e + i for i, e in enumerate(accumulate(map(len, parts)))]
            starts = [0, *[e + 1 for e in ends[:-words]]]
            made = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=True)]
        hashes += made
        counts.append(len(made))
    out = np.zeros(len(texts), np.uint64)
    sizes = np.array(counts, np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.cumsum(sizes[full]) - sizes[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * ones > sizes[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out.view(np.int64).tolist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, text_key, fp) for each row: the id, the text's xxhash64 and its fingerprint."""
    rows = appended(docs.select(id_col, text_col), text_col, lambda texts: {"fp": text_fingerprints(texts, words)}, "fp long", SLICE_CHARS)
    return rows.select(F.col("c0").alias(id_col), F.coalesce(F.xxhash64("c1"), F.lit(0)).alias("text_key"), "fp")


def code_anchors(bits: Column) -> Column:
    """The code words within 2 of a 31-bit value, its home first."""
    masks = [sum(1 << (p - 1) for p in range(1, CODE_BITS + 1) if p >> k & 1) for k in range(5)]
    syndrome = sum((F.bit_count(bits.bitwiseAND(F.lit(m).cast("long"))) % 2 * (1 << k) for k, m in enumerate(masks)), F.lit(0))
    bit = [F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(CODE_BITS)]]
    table = F.array(*bit)
    at = lambda p: F.element_at(table, (p + 1).cast("int"))
    home = bits.bitwiseXOR(at(syndrome))
    lower = F.filter(F.sequence(F.lit(1), F.lit(CODE_BITS)), lambda p: p < p.bitwiseXOR(syndrome))
    beside = F.transform(lower, lambda p: bits.bitwiseXOR(at(p)).bitwiseXOR(at(p.bitwiseXOR(syndrome))))
    return F.when(syndrome == 0, F.array(home)).otherwise(F.concat(F.array(home), beside))


def members(nodes: DataFrame) -> DataFrame:
    """(side, anchor, fp, home) for each anchor that a distinct fingerprint is replicated to."""
    half = F.shiftrightunsigned("fp", 32)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("fp").bitwiseAND(F.lit((1 << CODE_BITS) - 1).cast("long")).alias("bits")),
        F.struct(F.lit(1).alias("side"), half.bitwiseAND(F.lit((1 << CODE_BITS) - 1).cast("long")).alias("bits")),
    )
    placed = nodes.select("fp", F.explode(sides).alias("s")).select("fp", "s.side", code_anchors(F.col("s.bits")).alias("anchors"))
    return placed.select("fp", "side", F.posexplode("anchors").alias("nth", "anchor")).select("side", "anchor", "fp", (F.col("nth") == 0).cast("int").alias("home"))


def links(nodes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes`` (fp): a spanning forest for each anchor."""
    if threshold != THRESHOLD:
        raise ValueError("two halves with one differing bit cover a threshold of 3 only")
    spread = members(nodes)
    sizes = spread.groupBy("side", "anchor").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any_home")).filter("n > 1 and any_home = 1").drop("any_home")
    met = spread.drop("home").join(written(sizes, "anchor-sizes"), ["side", "anchor"])
    dealt = in_blocks(met, "n", F.xxhash64("fp")).drop("n")
    key = ["side", "anchor", "pair"]

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        a, b = [], []
        for group in runs(batches, key):
            fps = np.array(group["fp"], np.int64)
            if len(fps) == 2:
                if ((group["fp"][0] ^ group["fp"][1]) & (1 << 64) - 1).bit_count() <= threshold:
                    a.append(group["fp"][0])
                    b.append(group["fp"][1])
            else:
                for x, y in forest(len(fps), lambda i, rest, fps=fps: np.bitwise_count((fps[rest] ^ fps[i]).view(np.uint64)) <= threshold):
                    a.append(int(fps[x]))
                    b.append(int(fps[y]))
            if len(a) > 10_000:
                yield {"a": a, "b": b}
                a, b = [], []
        yield {"a": a, "b": b}

    return map_columns(dealt.repartition(*key).sortWithinPartitions(*key), run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for each row; the component id is its smallest id."""
    fps = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprint-nodes")
    roots = components(links(nodes.select("fp"), threshold))
    rooted = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-names")
    of = written(rooted.join(named, "root").select("fp", "component_id", "root"), "fingerprint-components")
    return fps.join(of, "fp").select(id_col, "text_key", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, one of each component: that of the smallest id, then of the
    smallest text hash. Only ids and hashes of removed rows are joined, by Spark's size check."""
    near = written(near_duplicates(docs, id_col, text_col, words, threshold), "near-duplicates")
    order = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_key")
    first = written(near.groupBy("root").agg(F.min(order).alias("first")), "component-firsts")
    judged = near.join(first, "root").withColumn("gone", order != F.col("first"))
    gone = written_side(judged.filter("gone").select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).distinct(), "removed")
    again = near.groupBy(id_col, "text_key").count().filter("count > 1").select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key"))
    again = written_side(again, "repeated")
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    by, at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    same = F.col(by).eqNullSafe(F.col("__id")) & (F.coalesce(F.xxhash64(at), F.lit(0)) == F.col("__key"))
    kept = flat.join(gone, same, "left_anti")
    if not again.isEmpty():
        alone = kept.join(again, same, "left_semi").withColumn("__key", F.xxhash64(at)).dropDuplicates([by, "__key"]).drop("__key")
        kept = kept.join(again, same, "left_anti").unionByName(alone)
    return kept.toDF(*names)
