from pyspark.sql import functions as F

from postlens.operators import stats as S
from postlens.sinks.feeds import map_feed, map_feed_columns, state_histogram_paths, write_state_histograms


def states(spark):
    return spark.createDataFrame([(0, "A"), (1, "B"), (2, "C")], "ord int, name string")


def posts(spark):
    rows = [(1, "A", "y", 10, 0.5), (2, "A", "y", 11, 0.1), (3, "A", "x", 12, -0.2), (4, "A", "x", 13, 0.3),
            (5, "B", "z", 14, 0.9), (6, None, "z", 15, 0.0), (7, "A", "w", None, 0.2)]
    return spark.createDataFrame(rows, "id long, state string, label string, `user-id` long, c double")


def test_majority_tie_takes_smallest(spark):
    out = {r["name"]: r["cluster_max_label"] for r in S.add_majority(states(spark), posts(spark)).collect()}
    assert out == {"A": "x", "B": "z", "C": None}


def test_state_stats_std_of_one_is_null(spark):
    out = {r["name"]: r for r in S.state_sentiment(posts(spark), states(spark), "c").collect()}
    assert out["B"]["count"] == 1 and out["B"]["std"] is None
    assert out["C"]["count"] is None and out["C"]["mean"] is None
    assert out["A"]["count"] == 5


def test_describe_quartiles_interpolate(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4)], "g string, v double")
    r = S.describe_by(df, "g", "v").first()
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 2.5, 3.25)
    assert r["std"] == df.agg(F.stddev_samp("v")).first()[0]


def test_value_counts_order_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a",), ("c",)], "v string")
    assert [(r["v"], r["n"]) for r in S.value_counts(df, "v").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert S.n_unique(df, "v").first()["n_unique"] == 3


def test_histogram_counts_sum_and_last_bin_closed(spark):
    df = spark.range(101).select((F.col("id") / 100.0).alias("x"))
    h = S.histogram(df, "x", bins=20).collect()
    assert len(h) == 20 and sum(r["n"] for r in h) == 101
    assert [r["n"] for r in h if r["bin"] == 19][0] == 6  # 0.95..1.0 inclusive
    const = spark.createDataFrame([(7.0,), (7.0,)], "x double")
    hc = {r["bin"]: r for r in S.histogram(const, "x").collect()}
    assert hc[10]["n"] == 2 and hc[0]["lo_edge"] == 6.5


def test_ratios_half_even_and_null_language(spark):
    df = spark.createDataFrame([("en",)] * 7 + [("fr",)] + [(None,)] * 0, "lang string")
    assert S.ratios(df).first()["pct_non_lang"] == 12.0  # 12.5 -> 12
    df2 = spark.createDataFrame([("en",), (None,)], "lang string")
    assert S.ratios(df2).first()["pct_non_lang"] == 50.0


def test_semi_anti_and_shape(spark):
    have = {r["name"] for r in S.states_with_posts(states(spark), posts(spark)).collect()}
    lack = {r["name"] for r in S.states_with_posts(states(spark), posts(spark), present=False).collect()}
    assert have == {"A", "B"} and lack == {"C"}
    r = S.shape(posts(spark)).first()
    assert (r["n_rows"], r["n_cols"]) == (7, 5)


def test_feeds(spark, tmp_dir):
    st = S.add_majority(states(spark), posts(spark))
    paths = {r["name"]: r["hist_label"] for r in
             state_histogram_paths(states(spark), posts(spark), label="label", states_key="name").collect()}
    assert paths["C"] == "No data" and paths["A"] == "image/hist_label/hist_label_A.jpg"
    feed = {r["name"]: r for r in map_feed_columns(st, "cluster_max_label").collect()}
    assert feed["C"]["cluster_max_label"] == "No data" and feed["A"]["n_fill"] == 3
    geo = map_feed(st, "cluster_max_label").collect()
    assert all(r["feature"].startswith('{"type":"Feature"') for r in geo)
    write_state_histograms(posts(spark), f"{tmp_dir}/h", label="label")
    back = spark.read.parquet(f"{tmp_dir}/h")
    assert back.filter("state = 'A'").count() == 3  # labels y, x, w


def test_retention_and_union(spark):
    r = S.retention(posts(spark), posts(spark).filter("state = 'A'")).first()
    assert (r["n_initial"], r["n_final"]) == (7, 5)
    u = S.union_all([states(spark), spark.createDataFrame([("D", 9)], "name string, extra int")])
    assert u.count() == 4 and "extra" in u.columns


def test_ranked_quartiles_equal_percentile(spark):
    import random
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, float(rng.randint(-3, 3)), rng.random() * 1e6])) for _ in range(3000)]
    rows += [("one", 5.0), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    plain, ranked = (sorted(map(tuple, S.describe_by(df, "g", "x", prefix="c_", ranked=r).collect())) for r in (False, True))
    assert len(plain) == 6 and [r[0] for r in plain] == [r[0] for r in ranked]
    for a, b in zip(plain, ranked, strict=True):
        assert a[1] == b[1] and a[4:] == b[4:], (a, b)  # count, min, quartiles and max are equal to the bit
    assert S.describe_by(df.limit(0), "g", "x", ranked=True).count() == 0
    assert S.describe_by(df, ["g"], "x", ("p50",), ranked=True).columns == ["g", "p50"]
    q = S.exact_quantiles(df, "g", "x", {"lo": 0.0, "p90": 0.9, "hi": 1.0})
    want = df.filter("x IS NOT NULL").groupBy("g").agg(F.min("x"), F.expr("percentile(x, 0.9)"), F.max("x"))
    assert sorted(map(tuple, q.filter("g IS NOT NULL").collect())) == sorted(map(tuple, want.filter("g IS NOT NULL").collect()))


def test_no_task_holds_a_group(spark):
    """The running sums of a hot group are dealt by partition, not by group."""
    df = spark.range(100_000).selectExpr("'hot' AS g", "cast(id AS double) AS x").repartition(4)
    rows = S.exact_quantiles(df, "g", "x", {"p50": 0.5})
    assert [tuple(r) for r in rows.collect()] == [("hot", 49999.5)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and plan.count("Window") == 3
