import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from postlens.llm import blocks
from postlens.llm.components import components
from postlens.llm.simhash_anchors import code_anchors, keep_one, links, near_duplicates, text_fingerprints


def fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def classes(values, linked):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]) and find(i) != find(j):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_fingerprints(prose):
    texts = [prose(n) for n in (1, 2, 3, 4, 50, 3000)] + [None, "", " \n", "É A b"]
    assert text_fingerprints(texts) == [signed(fingerprint(t)) for t in texts]


def test_anchors_cover(spark):
    rng = random.Random(3)
    values = [rng.getrandbits(31) for _ in range(60)]
    values += [v ^ 1 << rng.randrange(31) for v in values]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", code_anchors(F.col("v")).alias("a")).collect()
    near = [set(r.a) for r in rows]
    assert all(len(r.a) in (1, 16) and all((r.v ^ a).bit_count() <= 2 for a in r.a) for r in rows)
    assert all(rows[i].a[0] in near[i + 60] and (rows[i].v ^ rows[i].a[0]).bit_count() <= 1 for i in range(60))


def test_links_keep_every_component(spark, monkeypatch):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = set(base)
    for b in base:
        for _ in range(rng.randint(0, 12)):
            b ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, 3)))
            values.add(b)
    dense = {base[0] ^ 1 << i ^ 1 << j for i in range(9) for j in range(9)}
    values = sorted(signed(v) for v in values | dense)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    expected = classes(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    for block in (2048, 8):
        monkeypatch.setattr(blocks, "BLOCK", block)
        found = {r.node: r.root for r in components(links(nodes)).collect()}
        got = [values.index(found.get(v, v)) for v in values]
        assert len({*zip(got, expected, strict=True)}) == len(set(got)) == len(set(expected))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(300, 340)] + [(5, 5), (2, 1), (1, 2)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert {found[x] for x in range(100, 141)} == {100} and {found[x] for x in range(300, 340)} == {7} and found[2] == 1
    assert components(frame.limit(0)).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {(r.doc_id, r.fp): r.component_id for r in rows}
    assert {r.component_id for r in rows if r.doc_id in (1, 8)} == {1} and {r.component_id for r in rows if r.fp == 0} == {2}
    assert any(k[0] is None for k in of)
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert len({r.root for r in rows}) == kept.count()
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0
    assert np.array_equal(sorted(r.doc_id or 0 for r in kept.select("doc_id").collect())[-3:], [7, 7, 9])
