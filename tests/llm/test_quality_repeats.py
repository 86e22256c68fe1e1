import random

import numpy as np

from postlens.llm.quality_repeats import RepeatRules, keep_good, longest_repeats, repetition, text_counts


def brute(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i], out[j] = max(out[i], k), max(out[j], k)
    return [x if x >= 2 else 0 for x in out]


def test_longest_repeats_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(4)]
        sizes = np.array([len(t) for t in texts])
        if not sizes.sum():
            continue
        words, doc = np.array([ord(c) - 97 for t in texts for c in t]), np.repeat(np.arange(4), sizes)
        assert longest_repeats(words, doc, np.cumsum(sizes)[doc]).tolist() == sum(map(brute, texts), [])


def test_counts():
    line = "a b c d e f"
    made = text_counts([f"{line}\n{line}\n\nx# $y z", None, "", "one\x1ctwo"], 5)
    assert made["n_words"] == [14, 0, 0, 1] and made["n_dup_lines"] == [1, 0, 0, 0]
    assert made["n_symbols"] == [2, 0, 0, 0] and made["n_repeat_words"] == [12, 0, 0, 0]
    assert made["longest_repeat"] == [6, 0, 0, 0] and made["word_chars"] == [12 + 2 + 4, 0, 0, 7]


def test_odd_rows(odd_docs, no_docs, prose, spark):
    rows = repetition(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[1]) == 3 and all(r.kept for r in by[1]) and by[6][0].kept
    assert not by[2][0].kept and not by[3][0].kept and by[4][0].n_words == 0 and not by[9][0].kept
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 1, 6, 7, 8]
    assert repetition(no_docs).count() == 0 and keep_good(no_docs).columns == odd_docs.columns
    passage = prose(150)
    twice = spark.createDataFrame([(1, f"{prose(2000)} {passage} {prose(20)} {passage}")], "doc_id long, text string")
    row = repetition(twice, RepeatRules()).first()
    assert not row.base_failed and not row.kept and row.longest_repeat == 150


def test_each_limit_acts_behind_the_base_rule(spark, prose):
    line, passage = prose(13), prose(60)
    rows = [
        (1, f"{prose(60)} {line} {prose(60)} {line} {prose(20)}"),  # 26 of 166 words
        (2, f"{prose(400)} {line} {prose(60)} {line} {prose(20)}"),
        (3, f"{prose(1500)} {passage} {prose(60)} {passage}"),  # 120 of 1,680 words, one repeat of 60
        (4, prose(1700)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repetition(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i: r.kept for i, r in got.items()} == {1: False, 2: True, 3: False, 4: True}
    assert got[1].n_covered_words >= 26 and got[3].longest_repeat >= 60
    wide = RepeatRules(max_covered=0.2, max_longest=100)
    assert all(r.kept for r in repetition(docs, wide).collect())
    assert sorted(r.doc_id for r in keep_good(docs).collect()) == [2, 4]
