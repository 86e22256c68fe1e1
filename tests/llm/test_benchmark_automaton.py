import hashlib
import random
import re

import pytest

from postlens.llm.benchmark_automaton import LeakRules, SuffixAutomaton, contamination, decontaminate
from postlens.llm.item_blocks import item_blocks, text_words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        v = words(item)
        k = min(len(v), window)
        grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                if name is not None:
                    names.add(str(name))
    return len(w), len(hit), sorted(names)


def places(spans):
    return [i for s in spans for i in range(s["start"], s["end"])]


def check(spark, docs, items, **rules):
    d = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, n_words int, spans string")
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    r = LeakRules(**rules)
    made = contamination(d, q, r).collect()
    got = sorted(((x["doc_id"], x["n_words"], x["n_hit"], list(x["items"])) for x in made), key=str)
    assert got == sorted(((i, *brute(t, items, r.window)) for i, t in docs), key=str)
    assert all(len(set(places(x["spans"]))) == x["n_hit"] == len(places(x["spans"])) for x in made)


def glued(rng, items, vocabulary):
    """A text of random words with pieces of items."""
    out = []
    for _ in range(rng.randint(1, 6)):
        out += rng.choices(vocabulary, k=rng.randint(0, 12))
        v = words(rng.choice(items)[1])
        if v:
            a = rng.randrange(len(v))
            out += v[a : a + rng.randint(1, len(v))]
    return rng.choice([" ", ", ", "\n"]).join(out)


@pytest.mark.parametrize("window", [1, 3, 10])
def test_equals_brute_force(spark, window):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(8)]  # few words, so that items overlap and states split
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 9, 10, 11, 30])))) for i in range(25)]
    items = [x for x in items if window > 1 or len(words(x[1])) > 1]
    docs = [(i, glued(rng, items, [*vocabulary, "other"])) for i in range(120)]
    check(spark, docs, items, window=window)
    check(spark, docs, items, window=window, block_chars=200)  # several blocks, chained


def test_odd_rows(spark, prose):
    long = prose(20_000)
    passage = " ".join(long.split()[5000:5030])
    items = [(1, "Ein zwei, DREI"), (1, passage), (2, None), (3, ""), (4, " .,"), (None, "null id item"), (5, passage), (6, "é"), (5, passage)]
    docs = [(1, "x ein ZWEI drei y"), (2, None), (3, ""), (4, "\n"), (None, "null id item"), (5, long), (6, passage.upper()), (6, passage.upper()), (7, "É é e"), (8, "ein zwei")]
    check(spark, docs, items)
    check(spark, docs, items, block_chars=20)


def test_empty_tables(spark):
    check(spark, [], [(1, "a b")])
    check(spark, [(1, "a b"), (2, None)], [])
    check(spark, [(1, "a b")], [(1, None)])


def test_longest_match_follows_suffix_links():
    items = ((None, (b"a", b"b", b"c", b"d")), (None, (b"b", b"c", b"e", b"f")))
    made = SuffixAutomaton(items, 10)
    assert made.scan(["a b c e f x a b"])[1] == [4]  # "a b c" falls back to "b c", then goes on


def test_blocks_hold_every_item_once(spark):
    items = [(i, " ".join(f"w{j}" for j in range(i % 9))) for i in range(200)]
    q = spark.createDataFrame(items + items, "item_id long, text string")
    blocks = list(item_blocks(q, "item_id", "text", 150))
    assert len(blocks) > 5 and all(sum(len(b" ".join(w)) for _, w in b) <= 150 for b in blocks)
    assert sorted(x for b in blocks for x in b) == sorted((str(i), tuple(text_words(t))) for i, t in items if text_words(t))


def test_decontaminate(spark):
    rng = random.Random(2)
    item = " ".join(f"t{i}" for i in range(40))
    clean = " ".join(f"c{rng.randrange(500)}" for _ in range(60))
    docs = [
        (1, f"{clean}. {item.title()}! {clean}", "en"),  # the passage goes
        (2, item, "en"),  # covered as a whole: the row goes
        (3, clean, None),
        (4, None, "en"),
        (5, f"{clean} t0 t1 t2 t3 t4 t5 t6 t7 t8 {clean}", "en"),  # nine words are no window
        (5, f"{clean} s1 s2 {clean}", "en"),  # a short item marks, but its span is too short to go
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string, spans string")
    q = spark.createDataFrame([(1, item), (2, "s1 s2")], "item_id long, text string")
    kept = decontaminate(d, q)
    assert kept.columns == d.columns and kept.schema == d.schema
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, f"{clean}. ! {clean}", "en"), *docs[2:]], key=str)
    assert decontaminate(d.limit(0), q).count() == 0


def test_digest_columns(spark, tmp_path):
    from postlens.llm.queries import op13_benchmark_automaton

    docs = [(3, "a b c d e f g h i j k"), (1, "clean"), (None, None)]
    items = [(10, "a b c d e f g h i j"), (9, "b c d e f g h i j k")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {r["doc_id"]: r for r in op13_benchmark_automaton(spark, str(tmp_path)).collect()}
    assert (rows[3]["n_hit"], rows[3]["n_items"], rows[3]["contaminated"]) == (11, 2, True)
    assert rows[3]["items_sha256"] == hashlib.sha256(b"10,9").hexdigest()
    assert rows[1]["items_sha256"] == hashlib.sha256(b"").hexdigest() and rows[None]["n_words"] == 0
