import os
import time

from postlens.sources.jsonl import json_paths, latest_file, list_files, sample_files
from postlens.sources.states import read_state_tables, state_dim, us_states


def test_json_paths_is_prefix_glob():
    assert json_paths("data/json/") == "data/json/*.json"
    assert json_paths("data/json") == "data/json*.json"


def test_sample_and_latest(spark, tmp_dir):
    for i in range(9):
        with open(os.path.join(tmp_dir, f"f{i}.json"), "w") as fh:
            fh.write('{"id": %d}\n' % i)
        t = time.time() - 100 + i
        os.utime(os.path.join(tmp_dir, f"f{i}.json"), (t, t))
    pat = os.path.join(tmp_dir, "*.json")
    assert list_files(spark, pat).count() == 9
    a = sample_files(spark, pat, seed=1)
    assert len(a) == 3 and a == sample_files(spark, pat, seed=1)
    assert latest_file(spark, pat).endswith("f8.json")


def test_state_tables(spark, tmp_dir):
    us = us_states(spark)
    assert us.count() == 50
    parts = [spark.createDataFrame([("TX", "Texas", "POINT(0 0)")], "STUSPS10 string, NAME10 string, geometry string"),
             spark.createDataFrame([("OH", "Ohio", "POINT(1 1)", 3)], "STUSPS10 string, NAME10 string, geometry string, x int")]
    assert state_dim(parts).columns == ["STUSPS10", "NAME10", "geometry"]
    p = os.path.join(tmp_dir, "st")
    state_dim(parts).write.parquet(p)
    assert read_state_tables(spark, [p]).count() == 2


def test_wkt_becomes_geojson(spark):
    import json

    from postlens.sinks.feeds import geometry_json, map_feed
    ring = [[30, 10], [40.5, 40], [-20, 0.4], [30, 10]]
    cases = {
        "POINT (30 10)": ("Point", [30, 10]),
        " point Z(30 +10 007.50)": ("Point", [30, 10, 7.5]),
        "SRID=4326; POINT(-1e-05 5.)": ("Point", [-1e-05, 5]),
        "LINESTRING(30 10,10 30 , 40 40)": ("LineString", [[30, 10], [10, 30], [40, 40]]),
        "POLYGON ((30 10, 40.5 40, -20 .4, 30 10),(1 1,\n2 2,  3 3, 1 1))": ("Polygon", [ring, [[1, 1], [2, 2], [3, 3], [1, 1]]]),
        "MultiPolygon (((30 10, 40.5 40, -20 .4, 30 10)), ((1 1,2 2,3 3,1 1)))": ("MultiPolygon", [[ring], [[[1, 1], [2, 2], [3, 3], [1, 1]]]]),
        "MULTIPOINT ((10 40), (40 30))": ("MultiPoint", [[10, 40], [40, 30]]),
        "MULTIPOINT (10 40, 40 30)": ("MultiPoint", [[10, 40], [40, 30]]),
        "MULTILINESTRING ((10 10, 20 20),(40 40, 30 30))": ("MultiLineString", [[[10, 10], [20, 20]], [[40, 40], [30, 30]]]),
        "POLYGON EMPTY": ("Polygon", []),
    }
    texts = [*cases, '{"type":"Point","coordinates":[1,2]}', None, "", "nowhere", "POINT (a b)", "CIRCLE (1 2)", "{broken", "POLYGON ((1 2)", "POINT (1 2))"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, geometry string, fill string")
    got = {r["id"]: json.loads(r["g"]) for r in df.select("id", geometry_json("geometry").alias("g")).collect()}
    for i, (kind, coordinates) in enumerate(cases.values()):
        assert got[i] == {"type": kind, "coordinates": coordinates}, texts[i]
    n = len(cases)
    assert got[n] == {"type": "Point", "coordinates": [1, 2]} and all(got[i] is None for i in range(n + 1, len(texts)))
    features = [json.loads(r["feature"]) for r in map_feed(df, "fill").collect()]
    assert all(f["type"] == "Feature" and (f["geometry"] is None or set(f["geometry"]) == {"type", "coordinates"}) for f in features)
