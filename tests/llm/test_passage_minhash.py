import random
import time

import numpy as np
import xxhash

from postlens.llm.blocks import forest
from postlens.llm.passage_minhash import FEW, PassageRules, cut_words, hashed_words, paragraphs, remove_passages, repeated_passages, shingle_sets, similar_sets, steps


def windows(text, n):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.95), (0.8, 0.99), (0.6, 0.9)):
        rules = PassageRules(similarity=similarity, recall=recall)
        assert 1 - (1 - similarity) ** rules.bands >= recall > 1 - (1 - similarity) ** (rules.bands - 1)


def test_shingle_sets():
    values = np.array([5, 3, 5, -1, 7, 7, 2], np.int64)
    assert shingle_sets(values, np.array([0, 2, 4]), np.array([3, 2, 2])).to_pylist() == [[3, 5], [-1, 5], [7]]
    assert shingle_sets(values, np.array([], np.int64), np.array([], np.int64)).to_pylist() == []


def test_similar_sets_against_all_pairs():
    rng = random.Random(2)
    for n in [2, 3, 10, FEW, FEW + 1, 120] * 3:
        bases = [rng.sample(range(1000), 12) for _ in range(n // 4 + 1)]
        sets = [sorted({*rng.choice(bases)[: rng.randint(10, 12)], 5000}) for _ in range(n)]
        linked = [[len({*a} & {*b}) >= 0.8 * len({*a} | {*b}) - 1e-9 for b in sets] for a in sets]
        want = forest(n, lambda i, rest: np.array([linked[i][r] for r in rest]))
        assert sorted(similar_sets(sets, 0.8)) == sorted(want)


def nearest(x, y, words):
    """The next places (in x, in y) from which ``words`` words agree, by all pairs."""
    same = [(a + b, a, b) for a in range(len(x) - words + 1) for b in range(len(y) - words + 1) if x[a : a + words] == y[b : b + words]]
    return min(same)[1:] if same else None


def test_steps_against_all_pairs():
    rng = random.Random(8)
    for _ in range(600):
        few, words = rng.choice([2, 4, 30]), rng.choice([2, 3, 5])
        x = [rng.randrange(few) for _ in range(rng.randrange(30))]
        y = [rng.randrange(few) if rng.random() < 0.1 else w for w in x if rng.random() < 0.95] + [rng.randrange(few)]
        want, i, j = [], 0, 0
        while True:
            n = next((k for k, (a, b) in enumerate(zip(x[i:], y[j:], strict=False)) if a != b), min(len(x) - i, len(y) - j))
            if n:
                want.append((i, j, n))
            i, j = i + n, j + n
            at = nearest(x[i:], y[j:], words)
            if at is None:
                break
            i, j = i + at[0], j + at[1]
        assert steps(x, y, words) == want


def test_steps_take_time_in_proportion_to_the_words():
    """A difference every seventh word: the places weren't noted once, but again at each difference."""
    x = list(range(20_000))
    y = [-1 if k % 7 == 6 else k for k in x]
    begin = time.process_time()
    assert steps(x, y, 5) == [(k, k, 6) for k in range(0, 19_999, 7)]
    assert time.process_time() - begin < 3


def test_hashed_words():
    rng = random.Random(1)
    for _ in range(200):
        texts = [rng.choice([None, "", " \n", "".join(rng.choices("aAbÄß \t\n\x0b\x1c\x85\u3000\0", k=rng.randrange(30)))]) for _ in range(4)]
        words = [(t or "").encode().lower().split() for t in texts]
        hashes, sizes = hashed_words(texts)
        assert sizes.tolist() == [len(w) for w in words] and hashes.tolist() == [xxhash.xxh3_64_intdigest(x) for w in words for x in w]


def test_growth_has_no_bound(spark):
    """Equal word pairs have no cut, so a long run of them stands beside a seed."""
    take = lambda n, at: " ".join(f"w{at + i}" for i in range(n))
    flat = " ".join(["again"] * 1500)  # equal pairs: one paragraph, cut at no place inside
    seed = take(60, 0)
    rows = [(1, f"{take(70, 1000)} {seed} {flat} {take(30, 2000)}"), (2, f"{take(70, 3000)} {seed} {flat} odd {take(30, 4000)}")]
    made = paragraphs([r[1] for r in rows], PassageRules())
    assert made.size.max() > 1400
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.n_words, r.removed) for r in found} == {(1, 70, 1560, False), (2, 70, 1560, True)}


def test_cut_words():
    assert cut_words("a b\nc  d e", [(1, 2)]) == "a d e" and cut_words("a b", [(0, 2)]) == "" and cut_words("é b c", [(2, 1), (0, 1)]) == "b "


def test_passages_against_brute_force(spark, prose):
    passages = [prose(n) for n in (60, 75, 120)]
    line = prose(13)
    rows = [(i, f"{prose(70)} {passages[i % 3]} {prose(90)}") for i in range(12)]
    rows += [(20 + i, f"{prose(100)}\n{line}") for i in range(4)] + [(30, prose(300))]
    rows += [(40, rows[0][1]), (41, rows[0][1].replace(" an", " xx", 1))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, removed string")
    found = repeated_passages(docs).collect()
    shared = {i for i, a in rows for j, b in rows if i != j and windows(a, 51) & windows(b, 51)}
    assert {r.doc_id for r in found} == shared
    assert all(r.first_doc_id <= r.doc_id and r.removed == (r.first_doc_id != r.doc_id) for r in found)
    out = remove_passages(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0] == rows[0][1] and texts[30] == dict(rows)[30] and all(texts[20 + i] == dict(rows)[20 + i] for i in range(4))
    seen = {}
    for i, t in texts.items():
        for w in windows(t, 51):
            assert seen.setdefault(w, i) == i


def test_repeats_inside_a_document(spark, prose):
    passage = prose(60)
    rows = [(1, "\n".join([prose(30), *[passage] * 50, prose(30)])), (2, f"{prose(40)}\n{passage}\n{prose(40)}\n{passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in remove_passages(docs).collect()}
    assert out[1].count(passage) == 1 and out[2].count(passage) == 0
    kept = passage.split()[20:40]
    assert out[1].count(" ".join(kept)) == 1 and out[2].count(" ".join(kept)) == 0
    assert out[1].startswith(rows[0][1][: len(rows[0][1].split("\n")[0])]) and out[1].split()[-20:] == rows[0][1].split()[-20:]


def test_passages_of_short_lines(spark, prose):
    lists = ["\n".join(prose(3) for _ in range(25)) for _ in range(4)]
    rows = [(i, f"{prose(50)}\n{lists[i % 4]}\n{prose(50)}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in repeated_passages(docs).collect()} == set(range(12))
    texts = {r.doc_id: r.text for r in remove_passages(docs).collect()}
    for i in range(12):
        assert (texts[i] == rows[i][1]) == (i < 4) and (lists[i % 4][80:-80] in texts[i]) == (i < 4)


def test_exact_passages_go_to_their_ends(spark):
    words = (f"w{i}" for i in range(10**6))  # none twice
    take = lambda n: " ".join(next(words) for _ in range(n))
    passages = [take(n) for n in (51, 55, 60, 100) * 10]
    rows = [(100 * k + i, f"{take(70)} {p} {take(70)}") for i in range(3) for k, p in enumerate(passages)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id, r.first_word, r.n_words, r.removed, r.first_doc_id) for r in found)
    assert got == sorted((100 * k + i, 70, len(p.split()), i > 0, 100 * k) for i in range(3) for k, p in enumerate(passages))


def test_edited_passages_go_whole(spark):
    words = (f"w{i}" for i in range(10**6))  # none twice
    take = lambda n: " ".join(next(words) for _ in range(n))
    rows, want = [], set()
    for k, (n, places) in enumerate([(60, (20,)), (60, (30,)), (60, (45,)), (100, (33, 66)), (100, (20, 80)), (60, (15, 30, 45))] * 5):
        passage = take(n).split()
        other = [f"e{k}_{i}" if i in places else w for i, w in enumerate(passage)]
        rows += [(2 * k, f"{take(70)} {' '.join(passage)} {take(70)}"), (2 * k + 1, f"{take(70)} {' '.join(other)} {take(70)}")]
        want |= {(2 * k, 70, n, False), (2 * k + 1, 70, n, True)} if len(places) < 3 else set()
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.n_words, r.removed) for r in found} == want


def test_odd_rows(odd_docs, no_docs):
    found = repeated_passages(odd_docs).collect()
    assert {r.doc_id for r in found} == {1, 8} and {r.first_doc_id for r in found} == {1}
    out = remove_passages(odd_docs)
    assert out.count() == odd_docs.count() and {r.doc_id for r in out.exceptAll(odd_docs).collect()} == {8}
    assert repeated_passages(no_docs).count() == 0 and remove_passages(no_docs).count() == 0
