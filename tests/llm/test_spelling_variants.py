import random
import re
import zlib
from collections import Counter

import pytest

from postlens.llm import spelling_variants as S
from postlens.llm.spelling_variants import VariantRules, variants

LOWER = {i: i + 32 for i in range(65, 91)}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    seen = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    seen = {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}
    beside = {w: sorted((-seen[x], x) for x in seen if near(w, x)) for w in seen}
    form = {w: b[0][1] if b and -b[0][0] >= 10 * seen[w] else None for w, b in beside.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, str(form[w]), root(w), n, len(beside[w]), seen[form[w]] if form[w] else 0) for w, n in seen.items())


def check(spark, docs):
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, word string, n int")
    made = variants(d)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((r["word"], str(r["form"]), r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in made.collect())
    assert got == brute(docs)
    return got


def corpus(seed, letters, stems, n):
    """Words with edits, of very different frequencies."""
    rng = random.Random(seed)
    words = []
    for _ in range(stems):
        w = "".join(rng.choices(letters, k=rng.randint(6, 12)))
        words += [w] * rng.choice([1, 2, 3, 30, 300])
        for _ in range(4):
            at, c = rng.randrange(len(w)), rng.choice(letters)
            words += [rng.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])] * rng.randint(1, 12)
    rng.shuffle(words)
    cut = [words[i : i + 50] for i in range(0, len(words), 50)]
    return [(i % n, " ".join(w.title() if rng.random() < 0.2 else w for w in part)) for i, part in enumerate(cut)]


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnopqrstuvwxyzñÿ×"])
def test_equals_brute_force(spark, letters):
    check(spark, corpus(len(letters), letters, 60, 40))


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 20)
    monkeypatch.setattr(S, "GROUPED", 15)
    monkeypatch.setattr(S, "QUERIES", 8)
    monkeypatch.setattr(S, "TASK_WORDS", 100)
    check(spark, corpus(1, "ab", 60, 40))
    check(spark, corpus(2, "abcd", 60, 40))


def test_chains_lead_to_a_root(spark):
    rare, mid, often = "abcdefgh", "abcdefgx", "abcdefyx"
    docs = [(i, " ".join([rare] * 2 + [mid] * 30 + [often] * 400)) for i in range(1)]
    got = {r[0]: r for r in check(spark, docs)}
    if len(got) == 3:
        assert got[rare][1:3] == (mid, often) and got[mid][1:3] == (often, often) and got[often][1:3] == ("None", often)


def test_ties_go_to_the_smallest_word(spark):
    check(spark, [(1, "zzabcdef " * 3 + "zyabcdef " * 40 + "zabcdef " * 40 + "zzabcdeg " * 40)])


def test_odd_rows(spark, prose):
    long = prose(1200) + " lengthening Lengthenings" * 20_000
    docs = [(1, None), (2, ""), (3, "7 . \n"), (None, "Ünïcödë wörter größer ünïcödë"), (None, None), (4, long), (4, long), (5, "a" * 5000 + " " + "a" * 5000), (5, "a" * 5001 + " " + "a" * 5001), (6, "日本語abcdefgh日 abcdefgh ſabcdefgh İabcdefg")]
    check(spark, docs)
    assert variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rules_need_halves(spark):
    with pytest.raises(ValueError):
        variants(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), VariantRules(least=5))
