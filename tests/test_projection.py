import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlens.errors import WrongColumnName
from postlens.operators import projection as P
from postlens.sources.jsonl import parse_lines, read_posts

DATE = "Wed Nov 04 02:03:04 +0000 2020"


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def rec(i, **kw):
    import json
    base = {"id": i, "created_at": DATE, "lang": "en", "place": None, "user": {"id": 7, "location": "Texas"}}
    base.update(kw)
    return json.dumps(base)


PATHS = [(("lang",), "string"), (("user", "location"), "string"), (("place", "name"), "string"),
         (("user", "id"), "bigint")]


def test_blank_lines_skipped(spark):
    raw = parse_lines(lines(spark, rec(1), "", "   ", rec(2)))
    assert raw.count() == 2


def test_malformed_line_raises(spark):
    raw = parse_lines(lines(spark, rec(1), "{bad"))
    with pytest.raises(Exception):
        raw.collect()


def test_duplicate_key_raises(spark):
    raw = parse_lines(lines(spark, '{"id":1,"id":2}'))
    with pytest.raises(Exception):
        raw.collect()


def test_flatten_nulls_and_types(spark):
    raw = parse_lines(lines(spark, rec(1), rec(2, place="text"), rec(3, place={"name": "Austin"}),
                            rec(4, user={"id": 9})))
    out = {r["id"]: r for r in P.flatten(raw, PATHS).collect()}
    assert out[1]["place-name"] is None            # always-null object
    assert out[2]["place-name"] is None            # wrong-typed object keeps the row
    assert out[3]["place-name"] == "Austin"
    assert out[4]["user-location"] is None         # missing nested key
    assert out[4]["user-id"] == 9
    assert out[1]["created_at"] == dt.datetime(2020, 11, 4, 2, 3, 4)
    assert P.flatten(raw, PATHS).columns[:2] == ["id", "created_at"]


def test_missing_root_names_it(spark):
    raw = parse_lines(lines(spark, rec(1), rec(2)))
    with pytest.raises(WrongColumnName) as e:
        P.flatten(raw, PATHS + [(("nolang",), "string")])
    assert "nolang" in str(e.value)


def test_opt_out_index_and_date(spark):
    raw = parse_lines(lines(spark, '{"lang":"en"}'))
    out = P.flatten(raw, [(("lang",), "string")], index=None, date=None)
    assert out.columns == ["lang"]


def test_first_text_priority(spark):
    cols = ["extended_tweet-full_text", "retweeted_status-extended_tweet-full_text", "retweeted_status-text", "text"]
    df = spark.createDataFrame([(1, "ext", "rx", "rt", "t"), (2, "", None, None, "t"), (3, None, None, None, None)],
                               "id int, `" + "` string, `".join(cols) + "` string")
    out = {r["id"]: r["full_text"] for r in P.first_text(df).collect()}
    assert out == {1: "ext", 2: "", 3: None}
    assert P.first_text(df).columns == ["id", "full_text"]


def test_numeric_columns_skips_null_booleans(spark):
    df = spark.createDataFrame([(1, 2.0, True, None, "x"), (2, 3.0, False, True, "y")],
                               "`user-id` long, f double, b boolean, nb boolean, s string")
    assert P.numeric_columns(df) == ["f", "b"]


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(WrongColumnName):
        P.drop_columns(df, ["b"])


def test_read_posts_arguments(spark, tmp_dir):
    p = f"{tmp_dir}/a.json"
    with open(p, "w") as fh:
        fh.write(rec(1) + "\n\n" + rec(2) + "\n")
    assert read_posts(spark, path_list=[p]).count() == 2
    assert read_posts(spark, folder=tmp_dir + "/").count() == 2
    with pytest.raises((ValueError, TypeError)):
        read_posts(spark)
    with pytest.raises((ValueError, TypeError)):
        read_posts(spark, path_list=[])
    with pytest.raises((ValueError, TypeError)):
        read_posts(spark, path_list=[3])


def test_select_preview_orders(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string")
    assert [r["id"] for r in P.select_preview(df, ["id"], n=2).collect()] == [1, 2]
    _ = F


def test_drift_in_one_pass(spark):
    from postlens.operators.drift import drift, merged_schema
    lines = ['{"id": 1, "a": {"b": 1, "c": null}, "x y": [1.5], "t`g": "s", "mixed": 1}', '{"id": 2, "a": {"b": 2.5}, "mixed": {"k": true}, "a-b": {"deep": {"er": "x"}}}',
             '[1, 2]', '7', '{}', '{"empty": {}}']
    df = spark.createDataFrame([(x,) for x in lines], "value string").selectExpr("parse_json(value) AS raw")
    paths = [(("a", "b"), "bigint"), (("a", "c"), "string"), (("a", "d"), "string"), (("gone", "deep"), "bigint"), (("mixed",), "bigint"), (("t`g",), "bigint")]
    got = {r["path"]: (r["declared"], r["drift"]) for r in drift(df, paths, roots=["id", "absent"]).collect()}
    assert got == {"a-d": ("string", "missing"), "gone-deep": ("bigint", "missing"), "absent": (None, "missing"), "mixed": ("bigint", "changed"),
                   "t`g": ("bigint", "changed"), "x y": (None, "new"), "a-b-deep-er": (None, "new"), "empty": (None, "new")}
    assert merged_schema(df.limit(0)).names == [] and drift(df.limit(0), paths[:1]).collect()[0]["drift"] == "missing"


def test_long_path_list(spark):
    """All 35 paths of the long list, typed, from a whole record; the root keys are checked by one pass."""
    import json

    from postlens import constants as K
    from postlens.errors import WrongColumnName
    from postlens.operators.projection import flatten
    values = {"string": "s", "bigint": 5, "boolean": True, "array<array<array<double>>>": [[[1.0, 2.0]]], "variant": {"hashtags": ["x"]}}
    record: dict = {"id": 1, "created_at": "Wed Nov 04 02:03:04 +0000 2020"}
    for path, kind in K.PATHS_LONG:
        at = record
        for key in path[:-1]:
            at = at.setdefault(key, {})
        at[path[-1]] = values[kind]
    record["user"]["created_at"] = "Thu Jan 01 00:00:01 +0000 2015"
    raw = spark.createDataFrame([(json.dumps(record),), ('{"id": 2, "created_at": null}',)], "value string").selectExpr("parse_json(value) AS raw")
    flat = flatten(raw, K.PATHS_LONG)
    assert len(K.PATHS_LONG) == 35 and flat.columns == ["id", "created_at", *["-".join(p) for p, _ in K.PATHS_LONG]]
    one, two = flat.orderBy("id").collect()
    for path, kind in K.PATHS_LONG:
        name = "-".join(path)
        if name == "user-created_at":
            assert one[name].year == 2015
        elif kind == "variant":
            assert one[name].toPython() == values[kind]
        else:
            assert one[name] == values[kind]
        assert two[name] is None
    import pytest
    with pytest.raises(WrongColumnName, match="entities"):
        flatten(raw.selectExpr("parse_json(regexp_replace(to_json(raw), 'entities', 'other')) AS raw"), K.PATHS_LONG)


def test_store_reads_its_days_only(spark, tmp_dir):
    import json
    import os

    from postlens.operators.filters import between_times
    from postlens.operators.projection import flatten
    from postlens.sources.jsonl import read_posts
    from postlens.streaming.store import read_store, start_store
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    paths = [(("lang",), "string"), (("user", "id"), "bigint")]
    for k in range(2):  # the second file comes after a restart
        with open(f"{src}/{k}.json", "w") as fh:
            for d in range(1, 9):
                fh.write(json.dumps({"id": 100 * k + d, "created_at": f"Sun Nov 0{d} 1{k}:00:00 +0000 2020", "lang": "en", "user": {"id": d}}) + "\n\n")
            fh.write('{"id": 9, "created_at": null}\n')
        start_store(spark, src, f"{tmp_dir}/store", f"{tmp_dir}/ck", paths, available_now=True).awaitTermination(120)
    bounds = ("2020-11-03 10:00:00+00:00", "2020-11-06 01:00:00+01:00")
    flat = flatten(read_posts(spark, folder=src + "/"), paths)
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(read_store(spark, f"{tmp_dir}/store")) == key(flat)
    got = read_store(spark, f"{tmp_dir}/store", *bounds)
    assert got.columns == flat.columns and key(got) == key(between_times(flat, *bounds)) and got.count() == 5
    days = {os.path.basename(os.path.dirname(f)) for f in got.inputFiles()}
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan and len(days) >= 4
    read = got.select("id", "_metadata.file_path").collect()
    assert {r["file_path"].split("day=")[1][:10] for r in read} == {"2020-11-03", "2020-11-04", "2020-11-05"}
