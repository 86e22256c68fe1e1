import random
import re

from pyspark.sql import functions as F

from postlens.llm.secret_ownership import OwnershipRules, entropy, mask_secrets, scanner, secret_spans

KEY = "AKIA" + "ABCD1234EFGH5678"
LIVE = "Zk9Qw3Rt7Yp1Lm5Xc8Vb2Nd4"


def test_scanner_by_hand():
    scan = scanner(OwnershipRules())
    assert scan("") == [] and scan("password: abc") == []
    assert [(k, s, e) for k, s, e, _ in scan('x PassWord = "s3cr3t.1" y')] == [(0, 2, 22)]
    assert [x[0] for x in scan(f"{KEY} {'0a' * 12} {'0a' * 11}f")] == [1, 2]
    assert [x[0] for x in scan(f"é {LIVE}.")] == [3] and scan(f"é {LIVE}.")[0][1:3] == (2, 26)
    assert [x[0] for x in scan(f"token={LIVE}")] == [0]
    assert scan("paſsword=abcdefgh") == []  # letters in either case, not their Unicode kin
    assert entropy("aaaa") == 0 and entropy("abcd") == 2


def test_ownership_and_mask(spark):
    rows = [(i, f"see {KEY} here", f"s{i}", 1) for i in range(4)]
    rows += [(10, f"my {LIVE} end token={'q' * 8}", "s1", 1), (11, None, "s1", 1), (12, "", None, 1), (None, f"a {LIVE}", "s1", 1), (12, "", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, spans long")
    got = {(r.doc_id, s.kind): (s.verdict, s.n_repos, s.n_owners) for r in secret_spans(docs).collect() for s in r.spans}
    assert got[0, "access"] == ("example", 4, 4) and got[10, "opaque"] == ("live", 2, 1) and got[10, "assign"] == ("unsure", 1, 1)
    assert secret_spans(docs).count() == len(rows)
    masked = mask_secrets(docs)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[0] == "see <access:example> here" and texts[10] == "my <opaque:live> end <assign:unsure>"
    assert texts[11] is None and texts[12] == "" and texts[None] == "a <opaque:live>"
    two = secret_spans(docs, OwnershipRules(live_owners=0)).select(F.explode("spans").alias("s")).filter("s.kind = 'opaque'")
    assert two.count() == 0


def test_opaque_under_two_owners(spark):
    low, many = "Xx1" + "x" * 30, LIVE[::-1]
    rows = [(i, f"my {LIVE} {low}", f"s{i}") for i in range(2)] + [(10 + i, f"see {many}", f"s{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = {r.doc_id: r.text for r in mask_secrets(docs).collect()}
    assert texts == {i: f"my <opaque:unsure> {low}" if i < 10 else t for i, t, _ in rows}


def test_odd_rows(odd_docs, no_docs):
    assert secret_spans(odd_docs).count() == odd_docs.count() and secret_spans(no_docs).count() == 0
    masked = mask_secrets(odd_docs)
    assert masked.columns == odd_docs.columns and masked.exceptAll(odd_docs).count() == 0 and mask_secrets(no_docs).count() == 0


def test_both_counts_decide(spark):
    rows = [(1, f"a {LIVE}", f"s{i}") for i in range(3)]  # one repository under three owners
    rows += [(10 + i, f"b {LIVE[::-1]}", "one") for i in range(11)]  # eleven repositories of one owner
    rows += [(30, "c " + LIVE.swapcase(), "one")] * 4  # one repository, repeated
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(s.verdict, s.n_repos, s.n_owners) for r in secret_spans(docs).collect() for s in r.spans}
    assert got == {("unsure", 1, 3), ("unsure", 11, 1), ("live", 1, 1)}
    by_team = docs.withColumn("team", F.lit("t"))
    assert {s.n_repos for r in secret_spans(by_team, repo_col="team").collect() for s in r.spans} == {1}


def test_random_texts_equal_a_plain_scan(spark):
    rng = random.Random(3)
    values = [LIVE, LIVE[::-1], "0a1b" * 7, KEY, "hunter22", "zz" * 12 + "A1", "abc"]
    glue = [" ", "\n", " é ", "token=", 'API_KEY": "', "passwd : ", "secret=", "🙂", "word "]
    rows = [(rng.randint(0, 30), "".join(rng.choice(glue + values) for _ in range(rng.randint(0, 14))), rng.choice(["s1", "s2", "s3", None])) for _ in range(150)]
    scan, repos, owners = scanner(OwnershipRules()), {}, {}
    for doc, text, source in rows:
        for *_, value in scan(text):
            repos.setdefault(value, set()).add(doc)
            owners.setdefault(value, set()).add(source)
    want = []
    for doc, text, _ in rows:
        spans = []
        for kind, start, end, value in scan(text):
            example, enough = len(owners[value]) >= 3 and len(repos[value]) >= 3, entropy(value) >= 3
            live = len(owners[value]) == 1 and len(repos[value]) <= 10 and enough
            if kind < 3 or (enough and not example):
                spans.append((start, end, kind, len(repos[value]), len(owners[value]), "example" if example else "live" if live else "unsure"))
        want.append((doc, sorted(spans, key=lambda s: (s[0], s[2]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, [(s.start, s.end, s.kind_no, s.n_repos, s.n_owners, s.verdict) for s in r.spans]) for r in secret_spans(docs).collect()]
    assert sorted(got) == sorted(want)
    plain = [(0, m.start(), m.end()) for _, t, _ in rows for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", t)]
    assert len(plain) == sum(k == 0 for _, t, _ in rows for k, *_ in scan(t)) > 50
