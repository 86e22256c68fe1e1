"""Physical-plan checks: the shape we want at scale, not just the answer."""

from postlens.operators import filters as FL
from postlens.operators import geo as G
from postlens.operators.sentiment import lexicon_frame, sentiment
from postlens.plans.standins import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_python_and_broadcasts_dims(spark):
    p = plan(QUERIES["label_counts_by_state"](spark, SF))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct"):
        assert bad not in p
    assert "BroadcastHashJoin" in p


def test_sentiment_is_broadcast_join_plus_partial_aggregate_by_hash(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS id", "text")
    p = plan(sentiment(df, lexicon_frame(spark, [("the", 0.4)]), ["text"]))
    assert "BroadcastHashJoin" in p and "partial_sum" in p
    assert p.count("Exchange hashpartitioning(_key#") == 1 and p.count("Exchange hashpartitioning") == 1
    assert "ObjectHashAggregate" not in p


def test_filters_reach_the_scan(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    assert "EqualTo(lang,en)" in plan(FL.keep_lang(d))
    e = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(FL.between_times(e, "2024-01-05 00:00:00+01:00", "2024-01-20 12:00:00", col="ts"))
    assert "GreaterThan(ts," in p and "LessThan(ts," in p


def test_state_match_is_narrow(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet").selectExpr("c_custkey AS id", "c_name AS loc")
    st = spark.read.parquet(f"{SF}/nation.parquet").selectExpr("n_nationkey AS ord", "n_name AS name")
    p = plan(G.state_from_text(c, st, "loc", alt_cols=(), order_col="ord"))
    assert "Exchange" not in p and "Join" not in p
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in p


def test_prepare_scans_captures_once(spark, tmp_dir):
    from postlens.plans.pipeline import prepare_posts
    from tests.test_pipeline import write_capture
    write_capture(f"{tmp_dir}/cap_1.json")
    lex = lexicon_frame(spark, [("good", 1.9), ("bad", -2.5)])
    for scorer in ("rules", "plain"):
        p = plan(prepare_posts(spark, lex, folder=tmp_dir + "/", validate=False, scorer=scorer))
        assert p.count("FileScan text") == 1


def test_one_parse_a_line(spark):
    assert plan(QUERIES["flatten_props"](spark, SF)).lower().replace("_", "").count("parsejson") == 1
    assert plan(QUERIES["capture_filter"](spark, SF)).count("from_json(") == 1


def test_no_nested_loop_and_lean_standins(spark):
    assert "NestedLoop" not in plan(QUERIES["state_matches_join"](spark, SF))
    assert "conversations" not in plan(QUERIES["label_counts_by_state"](spark, SF))
