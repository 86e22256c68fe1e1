from postlens.operators import cluster as C


def test_first_centres_by_ordered_limits(spark, monkeypatch):
    df = spark.range(2000).selectExpr("id", "double(id % 7) AS a", "double(id) AS b")
    rows = C._features(df, ["a", "b"], "id")
    plans, frame = [], type(rows)
    real = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or real(self))
    first = C._first_centers(rows, 2, 3, 4, 7)
    assert [len(c) for c in first] == [3] * 4
    # k rows a restart are kept in a task; a window would sort each row once a restart
    assert plans[0].count("TakeOrderedAndProject") == 4 and "Window" not in plans[0] and "Generate" not in plans[0]
