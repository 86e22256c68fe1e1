import math

import numpy as np
from tokenizers import Tokenizer

from postlens.llm.lexical_packing import PackingRules, ShardIndex, distinct_terms, pack, packed_shard, rarest_terms
from postlens.llm.queries import packing_digest, tokenizer


def pieces_of(rows):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    return by_doc, by_sequence


def test_index_scores_are_bm25():
    docs = [[5, 5, 7], [5, 9], [7, 7, 7, 9], [11]]
    ids = [np.array(d, "<u4").tobytes() for d in docs]
    frequency = np.zeros(1 << 16, np.int64)
    for d in docs:
        frequency[list(set(d))] += 1
    mean, rules = 10 / 4, PackingRules(query_terms=8)
    index = ShardIndex(ids, frequency, 4, mean, rules)

    def bm25(doc, term):
        n, tf = sum(term in d for d in docs), doc.count(term)
        return math.log1p((4 - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / mean))

    scores = {i: sum(bm25(d, t) for t in set(docs[0])) for i, d in enumerate(docs) if i and set(d) & set(docs[0])}
    unused = np.array([False, True, True, True])
    assert index.neighbours(0, unused).tolist() == sorted(scores, key=lambda i: -scores[i])
    windows = packed_shard([3, 2, 4, 1], index, PackingRules(window=5))
    assert sum(size for w in windows for _, _, size in w) == 10 and [sum(p[2] for p in w) for w in windows] == [5, 5]


def test_neighbours_share_a_window(spark, prose):
    topics = [prose(40).split() for _ in range(6)]
    rows = [(i, " ".join(topics[i % 6][(i * 7 + k) % 40] for k in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, sequences = pieces_of(pack(docs, tokenizer("byte_bpe_50k.json"), rules=PackingRules(window=400)).collect())
    by = {}
    for r in pack(docs, tokenizer("byte_bpe_50k.json"), rules=PackingRules(window=400)).collect():
        by.setdefault(r.sequence_id, []).append(r.doc_id % 6)
    pairs = [(w[0], x) for w in by.values() for x in w[1:]]
    assert sum(a == b for a, b in pairs) > 0.6 * len(pairs)


def test_every_id_once(odd_docs, no_docs):
    path = tokenizer("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rows = pack(odd_docs, path).collect()
    _, by_sequence = pieces_of(rows)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    expected = sorted(np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for r in odd_docs.collect())
    assert sum(r.length for r in rows) == sum(len(x) // 4 for x in expected)
    one = {i: np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for r in odd_docs.collect() if (i := r.doc_id) in (2, 3, 4, 5, 6, 9)}
    by_doc, _ = pieces_of(rows)
    for doc, ids in one.items():
        assert b"".join(x for _, x in sorted(by_doc[doc])) == ids
    assert packing_digest(pack(odd_docs, path)).columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
    assert pack(no_docs, path).count() == 0


def test_rarest_terms_against_sorting():
    rng = np.random.default_rng(4)
    rows = [rng.integers(0, 60, rng.integers(1, 30)) for _ in range(200)] + [np.array([65535] * 3), np.array([0])]
    rank = rng.permutation(1 << 16) << 16 | np.arange(1 << 16)
    a, b = rarest_terms([r.astype("<u4").tobytes() for r in rows], rank)
    for row, first, second in zip(rows, a.tolist(), b.tolist(), strict=True):
        terms = sorted(set(row.tolist()), key=lambda t: rank[t])
        assert [first, second] == [*terms, 0][:2]
    row, term, count = distinct_terms([r.astype("<u4").tobytes() for r in rows])
    assert [(i, t, r.tolist().count(t)) for i, r in enumerate(rows) for t in sorted(set(r.tolist()))] == list(zip(row.tolist(), term.tolist(), count.tolist(), strict=True))
