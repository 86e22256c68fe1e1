from itertools import combinations

from postlens.llm.url_rules import MiningRules, judge_urls, mined_rules

URLS = {
    "http://example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
    "https://a.WWW.Example.com/en/?q#x": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://x.com/fr/": ("x.com", "/fr/", "com/", "allow"),
    "http://x.com": ("x.com", "", None, "allow"),
    "http://b.net/es/9": ("b.net", "/es/9", "net/es/", "block"),
    "http://bnet/es/9": ("bnet", "/es/9", None, "allow"),
    "ftp://c.net/fr/?a://d": ("c.net", "/fr/", "net/fr/", "block"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "http://É.com?x=1": ("É.com", "", None, "allow"),
}


def test_explicit_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(99, None, "x"), (None, "no scheme", "x"), (0, "http://x.com", "x")], "page_id long, url string, verdict string")
    labelled = spark.createDataFrame([], "url string, bad boolean")
    rows = judge_urls(pages, labelled).collect()
    assert len(rows) == len(URLS) + 3
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows if r.page_id in range(1, len(URLS))}
    assert got == {i: v for i, v in enumerate(URLS.values()) if i}
    assert judge_urls(pages.limit(0), labelled).count() == 0


def test_mined_rules_equal_brute_force(spark):
    kinds = [("http://s.spam.org/win/1", True)] * 9 + [("http://s.spam.org/news/1", False)] * 8 + [("http://ok.org/win/2", False)] * 10
    kinds += [("http://s.spam.org/win/3", False)] * 2 + [("http://ok.org/a", None)] * 3 + [(None, True)] * 6
    labelled = spark.createDataFrame(kinds, "url string, bad boolean")
    rules = MiningRules(support=0.01, least=5, confidence=0.6)
    sets = {}
    for url, bad in kinds:
        if url is None or bad is None:
            continue
        host, _, rest = url.split("://")[1].partition("/")
        tokens = sorted({f"h:{x}" for x in host.split(".")} | {f"p:{x}" for x in rest.split("/")})
        for n in range(1, len(tokens) + 1):
            for part in combinations(tokens, n):
                a, b = sets.get(part, (0, 0))
                sets[part] = a + 1, b + bad
    good = {p for p, (n, b) in sets.items() if b >= 5 and b >= 0.6 * n}
    least = {p for p in good if not any(set(q) < set(p) for q in good)}
    assert {tuple(r.tokens) for r in mined_rules(labelled, rules).collect()} == least
    pages = spark.createDataFrame([(1, "http://s.spam.org/win/8"), (2, "http://s.spam.org/news/1"), (3, "http://t.org/win/2")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in judge_urls(pages, labelled, rules).collect()} == {1: "block", 2: "allow", 3: "allow"}
