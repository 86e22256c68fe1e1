import json
import os
import re

from postlens.streaming import capture as CAP

STATUS = json.dumps({"id": 1, "in_reply_to_status_id": None, "text": "Go #Biden!", "delete": "x"})
STATUS2 = json.dumps({"id": 2, "in_reply_to_status_id": None, "text": "trumpet solo"})
STATUS3 = json.dumps({"id": 3, "in_reply_to_status_id": None, "text": "x", "extended_tweet": {"full_text": "TRUMP"}})
DELETE = '{"delete":{"status":{"id":1,"user_id":2}}}'
LIMIT = '{"limit":{"track":7}}'
LIMIT2 = '{"limit":{"track":9}}'
WARN = '{"warning":{"code":"X","message":"slow down"}}'


def frame(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_routing_first_marker_wins(spark):
    df = CAP.route_messages(frame(spark, [STATUS, DELETE, LIMIT, WARN, '{"x":1}']))
    assert [r["kind"] for r in df.collect()] == ["status", "delete", "limit", "warning", "ignored"]


def test_notices(spark):
    routed = CAP.route_messages(frame(spark, [DELETE, LIMIT, LIMIT2, WARN]))
    d = CAP.delete_notices(routed).first()
    assert (d["status_id"], d["user_id"]) == (1, 2)
    m = CAP.missed_counter(routed).first()
    assert (m["missed"], m["n_notices"]) == (9, 2)
    assert CAP.warning_messages(routed).first()["message"] == "slow down"


def test_capture_frame_keywords(spark):
    df = frame(spark, [STATUS, STATUS2, STATUS3, DELETE])
    kept = [json.loads(r["value"])["id"] for r in CAP.capture_frame(df, ["biden", "trump"]).collect()]
    assert sorted(kept) == [1, 3]
    assert CAP.capture_frame(df, []).count() == 0


def _files(folder):
    """(name, lines) of the capture files; a file is one part."""
    out = []
    for name in sorted(os.listdir(folder)):
        parts = [p for p in os.listdir(os.path.join(folder, name)) if p.startswith("part-")] if name.startswith("file=") else []
        assert len(parts) <= 1
        out += [(name[5:], sum(1 for _ in open(os.path.join(folder, name, p)))) for p in parts]
    return out


def test_streaming_capture_matches_batch_and_rolls_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    msgs = [json.dumps({"id": i, "in_reply_to_status_id": None, "text": f"vote {i}"}) for i in range(25)]
    msgs += [DELETE, LIMIT]
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join(msgs) + "\n")
    out = os.path.join(tmp_dir, "out")
    q = CAP.start_capture(spark, src, out, ["vote"], os.path.join(tmp_dir, "ck"), prefix="cap",
                          max_records=10, available_now=True)
    q.awaitTermination(120)
    got = spark.read.text(os.path.join(out, "prefix=cap", "run=ck")).collect()
    batch = CAP.capture_frame(frame(spark, msgs), ["vote"]).collect()
    assert sorted(r["value"] for r in got) == sorted(r["value"] for r in batch)
    assert sorted(lines for _, lines in _files(os.path.join(out, "prefix=cap", "run=ck"))) == [5, 10, 10]


def _write(path, ids, word="vote"):
    with open(path, "w") as fh:
        for i in ids:
            fh.write(json.dumps({"id": i, "in_reply_to_status_id": None, "text": f"{word} {i}"}) + "\n")


def test_count_cap_and_restart_resumes(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    _write(os.path.join(src, "a.json"), range(20))
    q = CAP.start_capture(spark, src, out, ["vote"], ck, prefix="p", available_now=True)
    q.awaitTermination(120)
    assert spark.read.text(os.path.join(out, "prefix=p")).count() == 20
    # restart on the same checkpoint: only the new file is processed
    _write(os.path.join(src, "b.json"), range(100, 105))
    q = CAP.start_capture(spark, src, out, ["vote"], ck, prefix="p", available_now=True)
    q.awaitTermination(120)
    ids = sorted(json.loads(r["value"])["id"] for r in spark.read.text(os.path.join(out, "prefix=p")).collect())
    assert ids == list(range(20)) + list(range(100, 105))
    # count cap: exactly nb statuses
    src2, out2 = os.path.join(tmp_dir, "in2"), os.path.join(tmp_dir, "out2")
    os.makedirs(src2)
    _write(os.path.join(src2, "a.json"), range(30))
    q = CAP.start_capture(spark, src2, out2, ["vote"], os.path.join(tmp_dir, "ck2"), prefix="p", nb=7,
                          available_now=True)
    q.awaitTermination(120)
    assert spark.read.text(os.path.join(out2, "prefix=p")).count() == 7


def test_capture_feeds_prepare(spark, tmp_dir):
    from postlens.operators.sentiment import lexicon_frame
    from postlens.plans.pipeline import prepare_posts
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    post = {"id": 1, "created_at": "Wed Nov 04 02:03:04 +0000 2020", "lang": "en", "text": "vote good", "in_reply_to_status_id": None,
            "user": {"id": 5, "location": "Austin, Texas", "description": None, "name": "n", "screen_name": "s", "followers_count": 1,
                     "friends_count": 1, "listed_count": 1, "favourites_count": 1, "statuses_count": 1}}
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write(json.dumps(post) + "\n" + json.dumps(post) + "\n" + DELETE + "\n")
    q = CAP.start_capture(spark, src, out, ["vote"], os.path.join(tmp_dir, "ck"), prefix="p", available_now=True, run="r1")
    q.awaitTermination(120)
    got = prepare_posts(spark, lexicon_frame(spark, [("good", 1.9)]), path_list=CAP.capture_paths(out, "p"), validate=False).collect()
    assert [(r["id"], r["state"], r["full_text-sentiment-compound"]) for r in got] == [(1, "Texas", 0.4404)] * 2


def test_cap_stops_the_query_also_over_a_restart(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    _write(os.path.join(src, "a.json"), range(4))
    q = CAP.start_capture(spark, src, out, ["vote"], ck, prefix="p", nb=6, available_now=True)
    q.awaitTermination(120)
    _write(os.path.join(src, "b.json"), range(10, 14))
    q = CAP.start_capture(spark, src, out, ["vote"], ck, prefix="p", nb=6)
    assert not q.isActive and spark.read.text(os.path.join(out, "prefix=p")).count() == 6


def test_files_roll_across_batches_and_restarts(spark, tmp_dir):
    """Five batches of 10 lines with 20 a file give three files, named by time."""
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    for k in range(5):
        _write(os.path.join(src, f"{k}.json"), range(10 * k, 10 * k + 10))
        CAP.start_capture(spark, src, out, ["vote"], ck, prefix="cap", max_records=20, available_now=True).awaitTermination(120)
        n = 10 * (k + 1)
        assert [lines for _, lines in _files(f"{out}/prefix=cap/run=ck")] == [20] * (n // 20) + [n % 20] * (n % 20 > 0)
    names = [name for name, _ in _files(f"{out}/prefix=cap/run=ck")]
    assert all(re.fullmatch(r"cap_\d{8}-\d{6}_00000\d", x) for x in names) and len(names) == 3
    got = [json.loads(r["value"])["id"] for r in spark.read.text(CAP.capture_paths(out, "cap")).collect()]
    assert sorted(got) == list(range(50))


def test_a_batch_tried_again_writes_the_same(spark, tmp_dir):
    from postlens.streaming.rolling import RollingSink
    lines = lambda a, b: spark.createDataFrame([(f"line {i}",) for i in range(a, b)], "value string").repartition(3)
    sink = RollingSink(spark, f"{tmp_dir}/out", f"{tmp_dir}/state", "p", max_records=4, nb=17)
    for number, (a, b) in enumerate([(0, 3), (3, 3), (3, 9), (9, 15), (15, 30), (30, 40)]):
        for _ in range(2):
            sink.step(lines(a, b), number)
            before = _files(f"{tmp_dir}/out")
        RollingSink(spark, f"{tmp_dir}/out", f"{tmp_dir}/state", "p", 4, 17).step(lines(a, b), number)  # after a restart
        assert _files(f"{tmp_dir}/out") == before
        assert sink.written() == min(b, 17) == sum(n for _, n in before)
    assert [n for _, n in before] == [4, 4, 4, 4, 1] and sink.full()
    got = [r["value"] for r in spark.read.text(f"{tmp_dir}/out").collect()]
    assert len(set(got)) == 17 and {f"line {i}" for i in range(15)} < set(got)


def test_no_record_cap_and_no_limit_in_the_plan(spark, tmp_dir):
    from postlens.streaming.rolling import RollingSink, numbered
    sink = RollingSink(spark, f"{tmp_dir}/out", f"{tmp_dir}/state", "p", max_records=0)
    sink.step(spark.range(10).selectExpr("cast(id AS string) AS value"), 0)
    sink.step(spark.range(10, 15).selectExpr("cast(id AS string) AS value"), 1)
    assert sorted(int(r["value"]) for r in spark.read.text(f"{tmp_dir}/out").collect()) == list(range(15))
    rows, n = numbered(spark.range(1000).repartition(7).selectExpr("cast(id AS string) AS value"))
    assert n == 1000 and sorted(r["_seq"] for r in rows.collect()) == list(range(1000))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "SinglePartition" not in plan and "Window" not in plan
    rows.unpersist()


def _posts(path, rows):
    with open(path, "w") as fh:
        fh.write("".join(json.dumps(dict(zip(("state", "label", "user", "score"), r, strict=True))) + "\n" for r in rows))


def test_totals_after_a_restart_equal_the_batch(spark, tmp_dir):
    import random

    from postlens.operators import stats as S
    from postlens.streaming import totals as T
    rng = random.Random(3)
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    schema = "state string, label string, user long, score double"
    states = spark.createDataFrame([("A",), ("B",), ("Z",)], "name string")
    plans = {"labels": (T.label_totals(("state", "label"), "user"), ["state", "label"], "update"),
             "scores": (T.sentiment_totals("score"), ["state"], "complete"),
             "values": (T.value_totals("label"), ["label"], "update")}
    assert T.read_totals(spark, tmp_dir, "state", "labels") is None
    for k in range(3):
        rows = [(rng.choice(["A", "A", "B", None]), rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([0.5, -1.0, None])) for _ in range(40)]
        _posts(os.path.join(src, f"{k}.json"), rows)
        batch = spark.read.schema(schema).json(src)
        for name, (aggregate, keys, mode) in plans.items():
            stream = spark.readStream.schema(schema).json(src)
            T.start_totals(stream, aggregate, tmp_dir, os.path.join(tmp_dir, "ck", name), name, mode, available_now=True).awaitTermination(120)
            got = T.read_totals(spark, tmp_dir, keys, name, mode)
            want = aggregate(batch)
            assert got.columns == want.columns
            rounded = lambda rows: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)
            assert rounded(got.collect()) == rounded(want.collect())
    labels = T.read_totals(spark, tmp_dir, ["state", "label"], "labels")
    got = S.join_states(states, S.majority_of_counts(labels), "name", "state").collect()
    assert sorted(got) == sorted(S.add_majority(states, batch, "label", "state", "name", "user").collect())


def test_message_totals_on_a_stream(spark, tmp_dir):
    from postlens.streaming import totals as T
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for k, lines in enumerate([[STATUS, DELETE, LIMIT], [LIMIT2, WARN, '{"x":1}', STATUS2]]):
        with open(os.path.join(src, f"{k}.json"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        T.start_totals(spark.readStream.text(src), T.message_totals, tmp_dir, os.path.join(tmp_dir, "ck"), available_now=True).awaitTermination(120)
    got = {r["kind"]: (r["n"], r["missed"]) for r in T.read_totals(spark, tmp_dir, "kind").collect()}
    assert got == {"status": (2, None), "delete": (1, None), "limit": (2, 9), "warning": (1, None), "ignored": (1, None)}


def test_time_cap(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    q = CAP.start_capture(spark, src, os.path.join(tmp_dir, "out"), ["vote"], os.path.join(tmp_dir, "ck"), timeout_hours=1 / 3600)
    assert not q.isActive


def test_notices_and_features_on_a_stream(spark, tmp_dir):
    from postlens.operators.sentiment import lexicon_frame, sentiment
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join([STATUS, DELETE, LIMIT, LIMIT2, WARN, '{"x":1}']) + "\n")
    CAP.write_notices(spark, src, tmp_dir, os.path.join(tmp_dir, "ck1"), available_now=True).awaitTermination(120)
    rows = spark.read.parquet(os.path.join(tmp_dir, "notices")).collect()
    assert sorted((r["kind"], r["status_id"], r["missed"], r["message"]) for r in rows if r["kind"] != "limit") == [
        ("delete", 1, None, None), ("warning", None, None, "slow down")]
    assert max(r["missed"] for r in rows if r["kind"] == "limit") == 9
    lex = lexicon_frame(spark, [("biden", 1.0)])
    posts = CAP.capture_frame(spark.readStream.text(src), ["biden"]).select("value")
    CAP.feature_stream(posts, lambda b: sentiment(b, lex, ["value"]), os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "ck2"),
                       available_now=True).awaitTermination(120)
    batch = sentiment(frame(spark, [STATUS]), lex, ["value"]).collect()
    assert [tuple(r)[:2] for r in spark.read.parquet(os.path.join(tmp_dir, "f")).select(*batch[0].__fields__).collect()] == [tuple(r) for r in batch]
