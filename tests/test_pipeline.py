import json
import random

from postlens.operators.geo import us_states_frame
from postlens.operators.sentiment import lexicon_frame
from postlens.plans.pipeline import cluster_and_map, prepare_posts

LOCS = ["Austin, Texas", "Ohio", "Charleston, West Virginia", "somewhere", None, "NY", "Miami, FL", ""]
TEXTS = ["Trump is great", "Biden is terrible", "vote for Joe and Donald", "nothing good here",
         "republican win, democrat loss", "bad bad day", "great great GREAT", "hello"]


def write_capture(path, n=60, seed=3):
    rnd = random.Random(seed)
    with open(path, "w") as fh:
        for i in range(n):
            rec = {"id": 10_000_000_000 + i, "created_at": "Wed Nov 04 02:03:04 +0000 2020",
                   "lang": "en" if i % 5 else "fr", "text": rnd.choice(TEXTS),
                   "user": {"id": i % 17, "location": rnd.choice(LOCS), "description": rnd.choice(TEXTS + [None]),
                            "name": f"u{i}", "screen_name": f"s{i}", "followers_count": rnd.randint(0, 500),
                            "friends_count": rnd.randint(0, 300), "listed_count": rnd.randint(0, 9),
                            "favourites_count": rnd.randint(0, 99), "statuses_count": rnd.randint(1, 999)},
                   "place": None}
            if i % 7 == 0:
                rec["extended_tweet"] = {"full_text": rnd.choice(TEXTS) + " (extended)"}
            if i % 11 == 0:
                rec["retweeted_status"] = {"text": "rt", "user": {"screen_name": "x"}}
            fh.write(json.dumps(rec) + "\n")
            if i % 13 == 0:
                fh.write("\n")


def lexicon(spark):
    return lexicon_frame(spark, [("great", 3.1), ("good", 1.9), ("terrible", -2.5), ("bad", -2.5),
                                 ("win", 2.8), ("loss", -1.3)])


def test_prepare_and_cluster(spark, tmp_dir):
    write_capture(f"{tmp_dir}/cap_1.json")
    posts = prepare_posts(spark, lexicon(spark), folder=tmp_dir + "/").cache()
    cols = posts.columns
    for c in ["id", "created_at", "full_text", "full_text-contains_trump", "user-description-contains_biden",
              "full_text-sentiment-compound", "full_text-sentiment-compound-class", "label", "state"]:
        assert c in cols
    assert "text" not in cols and "extended_tweet-full_text" not in cols
    rows = posts.collect()
    assert rows and all(r["lang"] == "en" and r["state"] is not None for r in rows)
    assert all(r["full_text-sentiment-compound"] != 0 for r in rows)
    assert all(r["label"] is None or r["label"][:1] in "TBN" for r in rows)
    out = cluster_and_map(posts, us_states_frame(spark), n_init=1, max_iter=10, wide_k=3)
    labelled = out["posts"].collect()
    assert len(labelled) == len(rows)
    assert {r["kmlabel"] for r in labelled} <= set(range(6))
    st = {r["name"]: r for r in out["states"].collect()}
    assert len(st) == 50
    assert st["Texas"]["hist_kmlabel"].endswith("hist_kmlabel_Texas.jpg") or st["Texas"]["hist_kmlabel"] == "No data"
    assert st["Alaska"]["cluster_max_label"] is None and st["Alaska"]["hist_label"] == "No data"
    assert sum(r["count"] for r in out["cluster_label_counts"].collect()) == sum(
        1 for r in labelled if r["label"] is not None and r["user-id"] is not None)
    posts.unpersist()


def test_chain_with_the_elbow(spark, tmp_dir):
    """The wide model chooses its k by the elbow inside the chain, from posts of the store by day."""
    from postlens.streaming.store import read_store, start_store
    write_capture(f"{tmp_dir}/cap_1.json", n=120)
    start_store(spark, tmp_dir, f"{tmp_dir}/store", f"{tmp_dir}/ck", available_now=True).awaitTermination(120)
    flat = read_store(spark, f"{tmp_dir}/store", "2020-11-04 00:00:00+00:00", "2020-11-05 00:00:00+00:00")
    posts = prepare_posts(spark, lexicon(spark), flat=flat)
    want = prepare_posts(spark, lexicon(spark), folder=tmp_dir + "/")
    assert posts.columns == want.columns and posts.count() == want.count() > 0
    out = cluster_and_map(posts, us_states_frame(spark), n_init=2, max_iter=20)
    labels = {r["kmlabel_opt"] for r in out["posts"].select("kmlabel_opt").distinct().collect()}
    assert 2 <= len(labels) <= 10 and labels == set(range(len(labels)))


def test_wide_model_elbow_path(spark):
    from postlens.operators import cluster as C
    pts = [(i, float((i % 4) * 10 + (i % 3) * 0.3), float((i % 4) * 5 - (i % 2) * 0.2)) for i in range(80)]
    df = spark.createDataFrame(pts, "id long, a double, b double")
    out = C.km(df, ["a", "b"], n_cluster=None, max_cluster=8, n_init=2, max_iter=20, seed=7, out="kmlabel_opt")
    assert out.select("kmlabel_opt").distinct().count() >= 2
