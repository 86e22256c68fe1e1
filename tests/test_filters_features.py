import datetime as dt

import pytest

from postlens.errors import WordTypeError
from postlens.functions.text import keyword_pattern
from postlens.operators import features as FE
from postlens.operators import filters as FL


def test_time_bounds_are_strict(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 11, 3, 7, 15)), (2, dt.datetime(2020, 11, 3, 8, 0)),
                                (3, dt.datetime(2021, 1, 3, 21, 30))], "id int, created_at timestamp")
    out = FL.between_times(df, "2020-11-03 08:15:00+01:00", "2021-01-03 22:30:00+01:00")
    assert [r["id"] for r in out.collect()] == [2]


def test_drop_zero_keeps_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.5), (3, None)], "id int, c double")
    assert sorted(r["id"] for r in FL.drop_zero(df, "c").collect()) == [2, 3]


def test_keep_lang_drops_null(spark):
    df = spark.createDataFrame([(1, "en"), (2, "fr"), (3, None)], "id int, lang string")
    assert [r["id"] for r in FL.keep_lang(df).collect()] == [1]


def test_exclude_values_keeps_null(spark):
    df = spark.createDataFrame([(1, "Alaska"), (2, "Texas"), (3, None), (4, "Hawaii")], "id int, n string")
    assert sorted(r["id"] for r in FL.exclude_values(df, "n", ["Alaska", "Hawaii"]).collect()) == [2, 3]


def test_keywords_whole_word_case_insensitive(spark):
    df = spark.createDataFrame([(1, "#Biden!"), (2, "trumpet"), (3, "TRUMP"), (4, None)], "id int, full_text string")
    out = FL.track_keywords(df, ["biden", "trump"])
    assert sorted(r["id"] for r in out.collect()) == [1, 3]
    assert FL.track_keywords(df, []).count() == 0
    assert keyword_pattern([]) is None
    with pytest.raises(WordTypeError):
        FL.track_keywords(df, [3, True, "AAA"])


def test_topic_flags_null_in_null_out(spark):
    df = spark.createDataFrame([(1, "Go JOE", None), (2, "donald", "x")], "id int, full_text string, `user-description` string")
    rows = {r["id"]: r for r in FE.topic_flags(df).collect()}
    assert rows[1]["full_text-contains_biden"] is True
    assert rows[1]["full_text-contains_trump"] is False
    assert rows[1]["user-description-contains_trump"] is None
    assert rows[2]["full_text-contains_trump"] is True


def test_class_edges(spark):
    vals = [-1.0, -0.7, -0.2, 0.2, 0.7, 1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, c double")
    out = [r["c-class"] for r in FE.sentiment_classes(df, ["c"]).orderBy("id").collect()]
    assert out == ["tneg", "neg", "neutre", "pos", "tpos", "0", "0"]
    closed = FE.sentiment_classes(df, ["c"], close_last=True).orderBy("id").collect()
    assert closed[5]["c-class"] == "tpos"


def test_label_prefixes(spark):
    rows = [(1, True, True), (2, True, False), (3, False, True), (4, False, False), (5, None, True)]
    df = spark.createDataFrame([(i, a, b, "pos") for i, a, b in rows], "id int, a boolean, b boolean, cls string")
    out = [r["label"] for r in FE.add_label(df, "label", ("a", "T"), ("b", "B"), "N", "cls").orderBy("id").collect()]
    assert out == ["TBpos", "Tpos", "Bpos", "Npos", None]
