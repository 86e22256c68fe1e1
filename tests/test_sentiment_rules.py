"""Rule-based sentiment against a plain-Python brute force on a small fixture."""

import math
import string

from postlens.operators.sentiment import lexicon_frame
from postlens.operators.sentiment_rules import sentiment_rules
from postlens.sources.files import local_frame

LEX = {"good": 1.9, "bad": -2.5, "great": 3.1, "hate": -2.7, "love": 3.2, "kind": 2.0}
BOOST = {"very": 0.293, "extremely": 0.293, "slightly": -0.293, "kind": -0.293}
NEG = {"not", "never", "no"}


def phrase_valence(lw, i, idioms):
    """The longest phrase around word i, then the one that begins first."""
    for n in range(max(map(len, map(str.split, idioms)), default=0), 1, -1):
        for first in range(i - n + 1, i + 1):
            if first >= 0 and first + n <= len(lw) and " ".join(lw[first : first + n]) in idioms:
                return idioms[" ".join(lw[first : first + n])]
    return None


def brute(text, lex=LEX, boost=BOOST, idioms=None, pairs=()):
    words = []
    for t in (text or "").split():
        s = t.strip(string.punctuation)
        words.append(t if len(s) <= 2 else s)
    words = [w for w in words if len(w) > 1]
    lw = [w.lower() for w in words]
    up = [w.isupper() for w in words]
    capdiff = any(up) and not all(up)
    sent = []
    for i, w in enumerate(lw):
        if w in boost or w not in lex or (w == "kind" and lw[i + 1 : i + 2] == ["of"]):
            sent.append(0.0)
            continue
        v = lex[w]
        if up[i] and capdiff:
            v = v + 0.733 if v > 0 else v - 0.733
        for d in (1, 2, 3):
            if i >= d and lw[i - d] not in lex:
                s = boost.get(lw[i - d], 0.0)
                if s:
                    s = -s if v < 0 else s
                    if up[i - d] and capdiff:
                        s = s + 0.733 if v > 0 else s - 0.733
                s *= {1: 1.0, 2: 0.95, 3: 0.9}[d]
                v += s
                near, far = lw[i - 1] in ("so", "this"), i >= 2 and lw[i - 2] in ("so", "this")
                if d == 2 and lw[i - 2] == "never" and near:
                    v *= 1.5
                elif d == 3 and (lw[i - 3] == "never" and far or near):
                    v *= 1.25
                elif lw[i - d] in NEG or "n't" in lw[i - d]:
                    v *= -0.74
        told = phrase_valence(lw, i, idioms or {})
        v = v if told is None else told
        if any(i >= a and f"{lw[i - a]} {lw[i - a + 1]}" in pairs for a in (2, 3)):
            v -= 0.293
        if i and lw[i - 1] == "least" and "least" not in lex and not (i > 1 and lw[i - 2] in ("at", "very")):
            v *= -0.74
        sent.append(v)
    if "but" in lw:
        b = lw.index("but")
        sent = [s * 0.5 if j < b else (s * 1.5 if j > b else s) for j, s in enumerate(sent)]
    if not sent:
        return 0.0
    s = sum(sent)
    bang = min((text or "").count("!"), 4) * 0.292
    q = (text or "").count("?")
    qm = 0.0 if q <= 1 else (q * 0.18 if q <= 3 else 0.96)
    if s > 0:
        s += bang + qm
    elif s < 0:
        s -= bang + qm
    return round(max(-1.0, min(1.0, s / math.sqrt(s * s + 15))), 4)


TEXTS = ["The movie is GOOD", "very good", "not good", "good but bad", "good!!", "very very good",
         "I do not love it", "EXTREMELY bad day", "slightly great", "never not good", "hate hate love",
         "kind", "", None, "no", "what???", "good??", "I don't hate it!!!!!", "a b c", "GOOD BAD",
         "extremely, very good; but not great.", "love ... bad?!"]


def test_rules_match_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, t string")
    lex = lexicon_frame(spark, LEX.items())
    boo = local_frame(spark, BOOST.items(), "token string, scalar double")
    neg = local_frame(spark, [(w,) for w in NEG], "token string")
    out = {r["id"]: r["t-sentiment-compound"] for r in sentiment_rules(df, lex, boo, neg, ["t"]).collect()}
    for i, t in enumerate(TEXTS):
        assert out[i] == brute(t), (t, out[i], brute(t))


def test_rule_goldens(spark):
    df = spark.createDataFrame([(1, "not good"), (2, "very good"), (3, "good but bad")], "id long, t string")
    lex = lexicon_frame(spark, LEX.items())
    boo = local_frame(spark, BOOST.items(), "token string, scalar double")
    neg = local_frame(spark, [(w,) for w in NEG], "token string")
    out = {r["id"]: r for r in sentiment_rules(df, lex, boo, neg, ["t"], keep_struct=True).collect()}
    norm = lambda s: round(s / math.sqrt(s * s + 15), 4)
    assert out[1]["t-sentiment-compound"] == norm(1.9 * -0.74)
    assert out[2]["t-sentiment-compound"] == norm(1.9 + 0.293)
    assert out[3]["t-sentiment-compound"] == norm(1.9 * 0.5 - 2.5 * 1.5)
    st = out[2]["t-sentiment"]
    assert st["neu"] == 0.238 and st["pos"] == 0.762 and st["neg"] == 0.0  # pos 3.193, neu 1 (booster)


def tables(spark, lex=LEX, boost=BOOST):
    return (lexicon_frame(spark, lex.items()), local_frame(spark, boost.items(), "token string, scalar double"),
            local_frame(spark, [(w,) for w in NEG], "token string"))


SPECIAL = ["never so good", "never this bad a day", "it was never so very good", "so very so good", "least good", "at least good", "very least good",
           "the least bad", "kind of good", "kind of a good day", "kind of", "kind", "the bomb", "that was not the bomb", "yeah right, good",
           "a bad ass day", "bad ass", "kiss of death for good", "good kiss of death", "the bad ass bomb", "good :) :-(", "not :)", ":)", "(:-D)", "VERY :-D good"]
IDIOMS = {"the bomb": 3.0, "bad ass": 1.5, "the bad ass": -3.1, "yeah right": -2.0, "kiss of death for": -1.5, "good kiss": 0.9}


def test_idioms_emoticons_and_special_cases(spark):
    lex = LEX | {"bomb": -2.9, "death": -2.9, "right": 0.5, "kiss": 1.8, ":)": 2.0, ":-(": -1.9, ":-d": 2.3, "kind": 2.4}
    boost = {k: v for k, v in BOOST.items() if k != "kind"}
    words, boosters, neg = tables(spark, lex, boost | {"kind  of": -0.293, "Sort of": -0.293})
    idioms = local_frame(spark, [(k.replace(" ", "  ").title(), v) for k, v in IDIOMS.items()], "phrase string, valence double")
    texts = SPECIAL + ["sort of good", "sort of a good one", *TEXTS]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    out = {r["id"]: r["t-sentiment-compound"] for r in sentiment_rules(df, words, boosters, neg, ["t"], idioms=idioms).collect()}
    for i, t in enumerate(texts):
        assert out[i] == brute(t, lex, boost, IDIOMS, {"kind of", "sort of"}), (t, out[i], brute(t, lex, boost, IDIOMS, {"kind of", "sort of"}))


def test_idioms_change_scores(spark):
    words, boosters, neg = tables(spark, LEX | {"bomb": -2.9})
    df = spark.createDataFrame([(1, "it is the bomb")], "id long, t string")
    idioms = local_frame(spark, [("the bomb", 3.0)], "phrase string, valence double")
    plain, told = (sentiment_rules(df, words, boosters, neg, ["t"], idioms=x).first()["t-sentiment-compound"] for x in (None, idioms))
    assert plain < 0 < told


def test_random_texts_match_brute_force(spark):
    import random
    rng = random.Random(4)
    pieces = [*LEX, *BOOST, *NEG, "so", "this", "never", "least", "at", "but", "the", "x", "don't", "(good)", "...bad", "GOOD", "Very", "e.g.", "--", "it's!", "no,", "hate?", "\t", "\n\n", "é", "ÉTÉ", "a-b"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "  ", "! ", ", "]) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame([(i, t, t[::-1]) for i, t in enumerate(texts)], "id long, t string, c0 string")
    out = {r["id"]: r for r in sentiment_rules(df, *tables(spark), ["t", "c0"]).collect()}
    for i, t in enumerate(texts):
        assert out[i]["t-sentiment-compound"] == brute(t), t
        assert out[i]["c0-sentiment-compound"] == brute(t[::-1]) and out[i]["c0"] == t[::-1]


def test_repeated_idioms_rejected(spark):
    import pytest

    from postlens.errors import LexiconError
    df = spark.createDataFrame([(1, "good")], "id long, t string")
    again = local_frame(spark, [("the  bomb", 3.0), ("The bomb", 1.0)], "phrase string, valence double")
    with pytest.raises(LexiconError):
        sentiment_rules(df, *tables(spark), ["t"], idioms=again)


def test_generated_methods_are_short_enough_to_be_compiled(spark):
    """The JVM interprets methods over 8,000 bytes; those here run once a token or hit."""
    from postlens.plans.standins import QUERIES
    for name in ("sentiment_rules_posts", "sentiment_idioms", "sentiment_turns"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        stages = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package").codegenStringSeq(df._jdf.queryExecution().executedPlan())
        found = [stages.apply(i) for i in range(stages.size())]
        # the stages up to the aggregate by the row's hash (after it, a method runs once a row)
        sizes = [s._3().maxMethodCodeSize() for s in found if not s._1().split(") ", 1)[1].startswith("Project [") or "_key#" in s._1().split("\n")[0]]
        assert len(sizes) >= 3 and max(sizes) < 8000, sorted(sizes)
