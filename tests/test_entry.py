import re

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["state", "label", "n"]
    assert len(rows) > 0


def test_every_query_has_oracle_or_is_known_iterative():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}  # without the optional package
    assert own - set(o) == {"kmeans_elbow_events"}
    for name in q:
        assert "-" not in name
