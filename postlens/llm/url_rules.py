"""URL filters by association rules, in DataFrame functions and Spark's FP-growth only.

A URL's tokens are its host labels, path segments and parameter names. FP-growth mines the frequent
token combinations of labelled URLs together with the label ``bad``; a combination becomes a rule if it
is frequent enough with the label and most of its URLs bear it. A rule whose tokens include those of
another rule decides nothing more and is pruned. Rules are matched by an inverted index: each lies
under its rarest token, a URL looks up its own tokens and tests the rest of each rule found.
Explicit host and path rules, the longest that fits, come before mined ones.

Verdicts are a function of the URL, so distinct URLs are matched once and joined back by URL; a URL
in a third of all rows is one row until then, and adaptive execution splits that join.

Defined cases: a null URL or one without ``://`` has empty host and path, no tokens, and is allowed;
labels count once per labelled row; null labels don't count; without labelled rows there are no mined
rules; every input row gives one row; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: Explicit rules as (verdict, host, path).
EXPLICIT = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BAD = "=bad"


@dataclass(frozen=True)
class MiningRules:
    """``support``: share of the labelled URLs that hold a rule's tokens and are bad, at least;
    ``least``: their least number; ``confidence``: share of bad ones among those with the tokens."""

    support: float = 0.002
    least: int = 5
    confidence: float = 0.5


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: ``h:`` host labels, ``p:`` path segments, ``q:`` parameter names."""
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    marked = lambda mark, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    labels = marked("h:", F.split(host_of(url), r"\."))
    segments = marked("p:", F.split(path_of(url), "/"))
    names = marked("q:", F.transform(F.split(F.coalesce(query, F.lit("")), "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0)))
    return F.array_distinct(F.concat(labels, segments, names))


def explicit_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest explicit rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for action, at, below in sorted(EXPLICIT, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below)
        rule = F.when(fits, F.lit(at + below)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def mined_rules(labelled: DataFrame, rules: MiningRules = MiningRules()) -> DataFrame:
    """(tokens, anchor, n_with, n_bad) of the rules from ``labelled`` (url, bad): token combinations
    that make a URL bad, without those that include a shorter rule; ``anchor`` is the rarest token."""
    rows = labelled.filter("bad is not null").select(tokens_of(F.col("url")).alias("tokens"), "bad").filter(F.size("tokens") > 0)
    rows = written(rows.select("tokens", F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")), "transactions")
    n = rows.count()
    schema = "tokens array<string>, anchor string, n_with long, n_bad long"
    if not n:
        return labelled.sparkSession.createDataFrame([], schema)
    share = min(1.0, max(rules.support, (rules.least - 0.5) / n))  # half a row below, so that rounding up gives ``least``
    found = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0).fit(rows).freqItemsets
    sets = written(found.select(F.sort_array("items").alias("items"), F.col("freq").alias("n")), "itemsets")
    bad = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1) & (F.col("n") >= rules.least))
    bad = bad.select(F.array_remove("items", BAD).alias("items"), F.col("n").alias("n_bad"))
    kept = written(bad.join(sets, "items").filter(F.col("n_bad") >= rules.confidence * F.col("n")).select(F.col("items").alias("tokens"), F.col("n").alias("n_with"), "n_bad"), "rules")
    single = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("n").alias("held"))
    each = kept.select("tokens", "n_with", "n_bad", F.explode("tokens").alias("token")).join(single, "token")
    indexed = written(each.groupBy("tokens", "n_with", "n_bad").agg(F.min_by("token", F.struct("held", "token")).alias("anchor")), "rule-index")
    shorter = indexed.select(F.col("tokens").alias("part"), F.col("anchor").alias("token"))
    within = indexed.select("tokens", F.explode("tokens").alias("token")).join(shorter, "token").filter(
        (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
    )
    return indexed.join(within.select("tokens").distinct(), "tokens", "left_anti").select("tokens", "anchor", "n_with", "n_bad")


def matched_urls(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """The distinct ``url`` that some mined rule fits."""
    index = mined.select(F.col("tokens").alias("rule_tokens"), F.col("anchor").alias("token"))
    looked = urls.select("url").distinct().select("url", tokens_of(F.col("url")).alias("tokens")).select("url", "tokens", F.explode("tokens").alias("token"))
    return looked.join(index, "token").filter(F.size(F.array_except("rule_tokens", "tokens")) == 0).select("url").distinct()


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: MiningRules = MiningRules(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) for each row of ``pages``: ``rule`` is the explicit
    rule, ``mined`` whether a mined rule fits; without an explicit rule it decides."""
    rows = pages.select(id_col, F.col(url_col).alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    split = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = explicit_rule(F.col("host"), F.col("path"))
    split = split.withColumn("rule", rule).withColumn("given", verdict)
    mined = written(mined_rules(labelled, rules), "mined-rules")
    hits = written(matched_urls(rows.filter("url is not null"), mined).withColumnRenamed("url", "hit"), "matched-urls")
    judged = split.join(hits, F.col("url") == F.col("hit"), "left").withColumn("mined", F.col("hit").isNotNull())
    verdict = F.coalesce("given", F.when(F.col("mined"), "block").otherwise("allow"))
    return judged.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "mined")
