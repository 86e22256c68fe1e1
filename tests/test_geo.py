from postlens.operators import geo as G


def states(spark):
    return G.us_states_frame(spark)


def test_two_states_and_case(spark):
    df = spark.createDataFrame([(1, "Charleston, West Virginia"), (2, "arkansas"), (3, None), (4, "")],
                               "id long, `user-location` string")
    m = {r["id"]: r["state_matches"] for r in G.state_matches(df, states(spark)).collect()}
    assert m[1] == ["Virginia", "West Virginia"]
    assert m[2] == []
    assert m[3] is None and m[4] is None
    first = {r["id"]: r["state"] for r in G.state_from_text(df, states(spark)).collect()}
    assert first == {1: "Virginia", 2: None, 3: None, 4: None}
    longest = {r["id"]: r["state"] for r in G.state_from_text(df, states(spark), pick="longest").collect()}
    assert longest[1] == "West Virginia"
    h = {r["id"]: r["state"] for r in G.state_from_text(df, states(spark), pick="hash", seed=3).collect()}
    assert h[1] in ("Virginia", "West Virginia") and h[2] is None


def test_word_boundary_option(spark):
    df = spark.createDataFrame([(1, "CALIFORNIA DREAM")], "id long, `user-location` string")
    loose = G.state_matches(df, states(spark)).first()["state_matches"]
    strict = G.state_matches(df, states(spark), word_boundary=True).first()["state_matches"]
    # substring default: abbreviations inside the word match (AL, CA, IA, OR)
    assert {"Alabama", "California", "Iowa", "Oregon"} <= set(loose)
    assert strict == []


def test_table_join_equals_array(spark):
    df = spark.createDataFrame([(1, "Kansas City, MO"), (2, "Nowhere")], "id long, `user-location` string")
    a = sorted((r["id"], s) for r in G.state_matches(df, states(spark)).collect() for s in r["state_matches"])
    b = sorted((r["id"], r["state"]) for r in G.state_matches_join(df, states(spark)).collect())
    assert a == b


def test_address_state(spark):
    df = spark.createDataFrame([(1, "Houston, Harris County, Texas, United States"), (2, "New York, United States"),
                                (3, None)], "id long, address string")
    out = {r["id"]: r["state"] for r in G.state_from_address(df).collect()}
    assert out == {1: "Texas", 2: None, 3: None}


def test_gazetteer(spark):
    gz = spark.createDataFrame([("Austin", "Texas", 30.2, -97.7), ("New York", "New York", 40.7, -74.0),
                                ("Paris", None, 48.8, 2.3)], "city string, state string, lat double, lon double")
    df = spark.createDataFrame([(1, "Austin and New York"), (2, "Paris"), (3, "nowhere"), (4, None)],
                               "id long, `user-location` string")
    out = {r["id"]: r for r in G.gazetteer_state(df, gz).collect()}
    assert out[1]["state2"] == "Texas" and out[1]["coord"]["lat"] == 30.2
    assert out[2]["state2"] is None and out[2]["coord"]["lon"] == 2.3
    assert out[3]["state2"] is None and out[3]["coord"] is None
    assert out[4]["coord"] is None


def test_gazetteer_long_names_and_any_ids(spark):
    gz = spark.createDataFrame([("Village of the Branch", "New York", 40.8, -73.2), ("Truth or Consequences New Mexico", "New Mexico", 33.1, -107.2),
                                ("Branch", "Texas", 1.0, 2.0)], "city string, state string, lat double, lon double")
    df = spark.createDataFrame([(1, "in Village of the Branch"), (1, "nowhere"), (None, "Truth or Consequences New Mexico"), (1, "nowhere")],
                               "id long, `user-location` string")
    out = sorted((str(r["id"]), r["user-location"], str(r["state2"])) for r in G.gazetteer_state(df, gz).collect())
    assert out == [("1", "in Village of the Branch", "New York"), ("1", "nowhere", "None"), ("1", "nowhere", "None"),
                   ("None", "Truth or Consequences New Mexico", "New Mexico")]
    hashed = G.gazetteer_state(df, gz, pick="hash", seed=2).filter("state2 is not null")
    assert {r["state2"] for r in hashed.collect()} <= {"New York", "Texas", "New Mexico"} and hashed.count() == 2


def test_phonetic_codes():
    from postlens.constants import US_STATES
    from postlens.functions.phonetic import metaphone
    # FIXED VALUES: codes that the rules give
    want = {"Alabama": "ALBM", "Arkansas": "ARKNSS", "Connecticut": "KNKTKT", "Georgia": "JRJ", "Louisiana": "LXN", "Maine": "MN", "Massachusetts": "MSXSTS",
            "Minnesota": "MNST", "Mississippi": "MSSP", "New York": "N YRK", "North Dakota": "NR0 TKT", "Ohio": "OH", "Texas": "TKSS", "Utah": "UT",
            "Washington": "WXNKTN", "Wyoming": "YMNK"}
    assert {n: metaphone(n) for n in want} == want
    assert all(metaphone(n) for n, _ in US_STATES)
    words = {"knight": "NT", "school": "SKL", "church": "XRX", "dodge": "TJ", "phone": "FN", "bomb": "BM", "which": "WX", "science": "SNS", "thumb": "0M",
             "Xavier": "SFR", "quick": "KK", "gnome": "NM", "action": "AKXN", "match": "MX"}
    assert {w: metaphone(w) for w in words} == words
    assert metaphone(None) is None and metaphone("") is None and metaphone("12 -") is None


def test_abbreviation_meets_another_states_code(spark):
    """MN is Minnesota's abbreviation and Maine's phonetic code."""
    df = spark.createDataFrame([(1, "Minneapolis, MN"), (2, "Texas"), (3, "N YRK")], "id long, `user-location` string")
    m = {r["id"]: r["state_matches"] for r in G.state_matches(df, states(spark)).collect()}
    assert m[1] == ["Maine", "Minnesota"] and m[2] == ["Texas"] and m[3] == ["New York"]
    assert {r["id"]: r["state"] for r in G.state_from_text(df, states(spark)).collect()}[1] == "Maine"


def test_repeated_state_names_in_the_join_form(spark):
    twice = spark.createDataFrame([(0, "Ohio", "OH"), (1, "Ohio", "Buckeye")], "ord int, name string, abbr string")
    df = spark.createDataFrame([(1, "Buckeye, Ohio", 7)], "id long, `user-location` string, _ord int")
    rows = G.state_matches_join(df.drop("_ord"), twice).collect()
    assert sorted((r["state"], r["_ord"]) for r in rows) == [("Ohio", 0), ("Ohio", 1)]
