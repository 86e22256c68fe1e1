import math
import random
import re
from collections import Counter

from postlens.llm import ranked_search
from postlens.llm.ranked_search import SearchRules, ranked

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for w, x in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c in counted:
            m = 75 + (25 * sum(c.values()) * n) // total
            s = sum(weight[w] * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m)) for w in words(text) if w in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    extra = [(i, t, 0.5, "x", "q") for i, t in docs]
    return (
        spark.createDataFrame(extra, "doc_id long, text string, score double, rank string, query string"),
        spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id int"),
    )


def check(spark, docs, items, k=20, **rules):
    d, q = frames(spark, docs, items)
    made = ranked(d.repartition(5), q, SearchRules(k=k, **rules))
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute(docs, items, k)


def test_equals_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 16)  # many shards a task, so that bounds of earlier ones act
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ñandú", "x9"]
    text = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(63)], k=n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)]  # copies: ties at the k-th place
    items = [(i, text(rng.randint(1, 25))) for i in range(25)]
    check(spark, docs, items)
    check(spark, docs, items, k=3, block_chars=700)


def test_odd_rows(spark, prose):
    long = prose(20_000)
    docs = [(1, "Red red BLUE"), (2, None), (3, ""), (4, " ,.\n"), (None, "red green"), (None, None), (5, "red"), (5, "red"), (6, long), (7, "éTÉ 2x a_b"), (-8, "blue")]
    items = [(1, "red blue"), (1, "green"), (2, None), (3, ""), (4, "absent"), (None, "red"), (5, long[:200]), (6, "étÉ 2X b"), (1, "red blue")]
    check(spark, docs, items)
    check(spark, docs, items, k=1)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])
    check(spark, [(1, None)], [(1, "a"), (2, None)])


def test_accumulators_stop(spark):
    """A rare term and a common one: documents with only the common one get no accumulator."""
    doc, size = list(range(1000)), [10] * 1000
    import numpy as np

    post = np.concatenate([np.arange(30), np.arange(1000)]).astype("<i4")
    parts = [np.array([0, 1], "<i4"), np.array([0, 30, 1030], "<i4"), post, np.ones(1030, "<i4")]
    shard = ranked_search.Shard(doc, size, [p.tobytes() for p in parts], 1000, 10_000)
    found, score = shard.search([(0, 5000), (1, 3)], 20, 1)
    assert found.tolist() == list(range(30)) and len(set(score.tolist())) == 1
    assert score[0] == 5003 * int(shard.factor[0])
    assert len(shard.search([(1, 3)], 20, 1)[0]) == 1000
