import math

import pytest

from postlens.errors import LexiconError
from postlens.operators.sentiment import lexicon_frame, sentiment


def test_level0_score(spark):
    lex = lexicon_frame(spark, [("good", 1.9), ("great", 2.0), ("bad", -2.5)])
    df = spark.createDataFrame([(1, "Good, GREAT day"), (2, None), (3, ""), (4, "nothing here")],
                               "id long, full_text string")
    out = {r["id"]: r["full_text-sentiment-compound"]
           for r in sentiment(df, lex, ["full_text"]).collect()}
    assert out[1] == round(3.9 / math.sqrt(3.9 ** 2 + 15), 4) == 0.7096
    assert out[2] == out[3] == out[4] == 0.0


def test_struct_shares(spark):
    lex = lexicon_frame(spark, [("good", 2.0), ("bad", -1.0)])
    df = spark.createDataFrame([(1, "good bad meh"), (2, "")], "id long, t string")
    r = {x["id"]: x["t-sentiment"] for x in sentiment(df, lex, ["t"], keep_struct=True).collect()}
    # pos = 2+1 = 3, neg = |-1-1| = 2, neu = 1 -> total 6
    assert (r[1]["pos"], r[1]["neg"], r[1]["neu"]) == (0.5, 0.333, 0.167)
    assert (r[2]["pos"], r[2]["neg"], r[2]["neu"], r[2]["compound"]) == (0.0, 0.0, 0.0, 0.0)


def test_duplicate_tokens_rejected(spark):
    lex = lexicon_frame(spark, [("good", 1.0), ("Good", 2.0)])
    df = spark.createDataFrame([(1, "good")], "id long, t string")
    with pytest.raises(LexiconError):
        sentiment(df, lex, ["t"])


def test_every_row_kept_and_two_columns(spark):
    lex = lexicon_frame(spark, [("good", 1.0)])
    df = spark.createDataFrame([(i, "good" if i % 2 else "x", None) for i in range(50)],
                               "id long, a string, b string")
    out = sentiment(df, lex, ["a", "b"])
    assert out.count() == 50
    assert {r["b-sentiment-compound"] for r in out.collect()} == {0.0}


def test_carry_form_equals_join_back_and_keeps_duplicates(spark):
    from postlens.operators.sentiment import sentiment_carry
    lex = lexicon_frame(spark, [("good", 1.9), ("bad", -2.5)])
    rows = [(1, "good good", None), (1, "good good", None), (2, "", "bad"), (3, None, "good bad x")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    out = sorted((r["id"], r["a-sentiment-compound"], r["b-sentiment-compound"])
                 for r in sentiment_carry(df, lex, ["a", "b"], carry=["id"]).collect())
    assert len(out) == 4  # duplicate rows stay separate
    uniq = df.dropDuplicates()
    ref = sorted((r["id"], r["a-sentiment-compound"], r["b-sentiment-compound"])
                 for r in sentiment(uniq, lex, ["a", "b"]).collect())
    assert sorted(set(out)) == ref


def test_repeated_and_null_ids_are_scored_by_their_own_text(spark):
    from postlens.operators.sentiment_rules import sentiment_rules
    lex = lexicon_frame(spark, [("good", 1.9), ("bad", -2.5)])
    rows = [(1, "good"), (1, "good"), (3, "good"), (3, "bad"), (None, "bad"), (None, None), (4, "none")]
    df = spark.createDataFrame(rows, "id long, t string")
    score = {"good": 0.4404, "bad": -0.5423, "none": 0.0, None: 0.0}
    for f in (sentiment, sentiment_rules):
        out = [(r["id"], r["t"], r["t-sentiment-compound"]) for r in f(df, lex, text_cols=["t"]).collect()]
        assert sorted(map(str, out)) == sorted(str((i, t, score[t])) for i, t in rows)


def test_repeated_rows_in_steps(spark, monkeypatch):
    from postlens.operators import sentiment as S
    monkeypatch.setattr(S, "REPEAT_STEP", 3)
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 10)], "x string, n long")
    got = sorted(r["x"] for r in S.repeated(df, "n").collect())
    assert got == ["a"] + ["b"] * 3 + ["c"] * 10


def test_only_a_hash_is_grouped_by(spark):
    """No text, and no carried column, is a grouping key or goes with every token."""
    from postlens.operators.sentiment_rules import sentiment_rules
    lex = lexicon_frame(spark, [("good", 1.9)])
    df = spark.createDataFrame([(1, "good", "x")], "id long, t string, other string")
    for f in (sentiment, sentiment_rules):
        plan = f(df, lex, text_cols=["t"])._jdf.queryExecution().optimizedPlan().toString()
        keys = [line.split("Aggregate [", 1)[1].split("]", 1)[0] for line in plan.splitlines() if "Aggregate [_key" in line]
        assert keys and all(k.split("#")[0] == "_key" and "," not in k for k in keys)
        assert "lambda" not in plan


def test_rows_of_any_types_are_told_apart(spark):
    lex = lexicon_frame(spark, [("good", 1.9), ("bad", -2.5)])
    df = spark.sql("""SELECT * FROM VALUES (map('a', 1), parse_json('{"k": 1}'), array(1.5d), 'good', named_struct('x', null)),
      (map('a', 2), parse_json('{"k": 1}'), array(1.5d), 'good', named_struct('x', null)), (null, null, null, 'bad', null),
      (map('a', 1), parse_json('{"k": 2}'), array(1.5d), 'good', named_struct('x', 'y')) AS t(m, v, a, t, _row)""")
    got = sentiment(df, lex, ["t"])
    assert sorted((str(r["m"]), str(r["v"]), r["t-sentiment-compound"]) for r in got.collect()) == sorted(
        (str(r["m"]), str(r["v"]), {"good": 0.4404, "bad": -0.5423}[r["t"]]) for r in df.collect())


def test_marks(spark):
    lex = lexicon_frame(spark, [("good", 1.9), (":)", 2.0), ("<3", 1.0), ("x1", 5.0)])
    df = spark.createDataFrame([(1, "good :) <3 a:)"), (2, "x1 good"), (3, None), (4, ":)")], "id long, t string")
    norm = lambda s: round(s / math.sqrt(s * s + 15), 4)
    out = {r["id"]: r["t-sentiment"] for r in sentiment(df, lex, ["t"], keep_struct=True, marks=True).collect()}
    assert [out[i]["compound"] for i in (1, 2, 3, 4)] == [norm(4.9), norm(6.9), 0.0, norm(2.0)]
    assert {r["id"]: r["t-sentiment-compound"] for r in sentiment(df, lex, ["t"]).collect()} == {1: norm(1.9), 2: norm(1.9), 3: 0.0, 4: 0.0}
