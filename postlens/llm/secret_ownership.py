"""Secret scans with corpus-wide ownership frequency.

Every text is scanned for the base kinds (assignments, access keys, long hex) and for *opaque*
tokens: long mixed runs of key characters that no base span covers. The hash of each candidate's
value is then counted over the corpus: in how many distinct repositories and under how many
distinct owners it occurs. A value in many repositories of many owners is a copied example. A value
of high entropy in few repositories of one owner looks live; one that its owner copied widely is
unsure. The base spans always stay; an opaque token is a span, live or unsure, unless it is an
example or of low entropy.

Plan: one narrow scan writes the candidates (never the texts) to the shared folder; distinct
(value, repository) and (value, owner) pairs are made with map-side aggregation and spread by the
pair, then counted with map-side sums, so a value in a third of all rows meets no single task; the
joins run between written tables, where adaptive execution splits a hot value.

Defined cases: null or empty texts have no spans; a null owner counts as one owner and a null
repository as one repository, repeated rows of a repository count once; every input
row gives one output row, repeated rows and null ids too (rows are joined by a row key written
with the candidates, not by id); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import appended, written, written_side

#: Fixed patterns of the base kinds, in listed order.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6

SLICE_CHARS = 8_000_000


@dataclass(frozen=True)
class OwnershipRules:
    """``example_owners``, ``example_repos``: a value under so many owners and in so many
    repositories is a copied example. ``live_owners``, ``live_repos``: at most so many of both for a
    live-looking one, with ``live_entropy`` bits a character at least; ``live_owners`` 0 leaves
    opaque tokens out. ``opaque_chars``: shortest opaque token."""

    example_owners: int = 3
    example_repos: int = 3
    live_owners: int = 1
    live_repos: int = 10
    live_entropy: float = 3.0
    opaque_chars: int = 20


def entropy(value: str) -> float:
    """Shannon entropy, bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def scanner(rules: OwnershipRules):
    """A function from a text to its candidates: (kind number, start, end, value)."""
    run = rf"[A-Za-z0-9+/_=-]{{{rules.opaque_chars},}}"
    opaque = re.compile(rf"(?<![A-Za-z0-9+/_=-]){run}")
    digit, upper, lower = re.compile("[0-9]"), re.compile("[A-Z]"), re.compile("[a-z]")

    def scan(text: str) -> list[tuple[int, int, int, str]]:
        found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
        found += [(1, *m.span(), m[0]) for m in ACCESS.finditer(text)]
        found += [(2, *m.span(), m[0]) for m in HEX.finditer(text)]
        for m in opaque.finditer(text):
            s, e = m.span()
            if digit.search(m[0]) and upper.search(m[0]) and lower.search(m[0]) and not any(a < e and s < b for _, a, b, _ in found):
                found.append((3, s, e, m[0]))
        return sorted(found, key=lambda x: (x[1], x[0]))

    return scan


CANDIDATE = "array<struct<kind:int,start:long,end:long,value_sha256:string,entropy:double>>"


def candidates(docs: DataFrame, text_col: str = "text", rules: OwnershipRules = OwnershipRules()) -> DataFrame:
    """``docs`` with columns c0, c1, ... and its candidates as an array column ``found``."""
    scan = scanner(rules)

    def many(texts: list) -> dict[str, list]:
        return {"found": [
            [{"kind": k, "start": s, "end": e, "value_sha256": hashlib.sha256(v.encode()).hexdigest(), "entropy": entropy(v)} for k, s, e, v in scan(t or "")]
            for t in texts
        ]}

    return appended(docs, text_col, many, f"found {CANDIDATE}", SLICE_CHARS)


def ownership(found: DataFrame) -> DataFrame:
    """(value_sha256, n_repos, n_owners) of ``found`` (repo, owner, found): distinct repositories and
    distinct owners of each value. Nulls count as one of each."""
    held = found.select("repo", "owner", F.explode(F.array_distinct("found.value_sha256")).alias("value_sha256"))
    counted = [F.count_distinct(F.struct(c)).alias(f"n_{c}s") for c in ("repo", "owner")]  # a struct is never null
    return held.groupBy("value_sha256").agg(*counted)


def secret_spans(docs: DataFrame, rules: OwnershipRules = OwnershipRules(), id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """One row per document: ``row_key``, its id, the text's xxhash64, and ``spans``: an array of
    (start, end, kind, n_repos, n_owners, verdict) by start, then kind. Verdict: ``example``,
    ``live`` or ``unsure``. ``repo_col`` names the repository; by default each document is one."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(owner_col).alias("owner"), F.col(repo_col or id_col).alias("repo"))
    rows = candidates(base, "text", rules)
    found = written(
        rows.select(F.monotonically_increasing_id().alias("row_key"), F.col("c0").alias(id_col), F.coalesce(F.xxhash64("c1"), F.lit(0)).alias("text_key"), F.col("c2").alias("owner"), F.col("c3").alias("repo"), "found"),
        "secret-candidates",
    )
    with_any = found.filter(F.size("found") > 0)
    owners = written(ownership(with_any), "secret-owners")
    one = with_any.select("row_key", F.explode("found").alias("f")).select("row_key", "f.*")
    example = (F.col("n_owners") >= rules.example_owners) & (F.col("n_repos") >= rules.example_repos)
    live = (F.col("n_owners") <= rules.live_owners) & (F.col("n_repos") <= rules.live_repos) & (F.col("entropy") >= rules.live_entropy)
    verdict = F.when(example, "example").when(live, "live").otherwise("unsure")
    opaque = F.lit(rules.live_owners > 0) & ~example & (F.col("entropy") >= rules.live_entropy)
    judged = one.join(owners, "value_sha256").withColumn("verdict", verdict).filter((F.col("kind") < 3) | opaque)
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", F.col("kind").alias("kind_no"), "end", kind.alias("kind"), "n_repos", "n_owners", "verdict")
    by_row = judged.groupBy("row_key").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:long,kind_no:int,end:long,kind:string,n_repos:long,n_owners:long,verdict:string>>")
    return found.drop("found", "owner", "repo").join(by_row, "row_key", "left").withColumn("spans", F.coalesce("spans", none))


def mask_secrets(docs: DataFrame, rules: OwnershipRules = OwnershipRules(), id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with every span of ``text_col`` replaced by ``<kind:verdict>``.

    The spans come back by (id, text hash); equal rows have equal spans. Texts are rewritten with
    built-in string functions; only texts with a span are matched to more than a hash."""
    spans = secret_spans(docs, rules, id_col, text_col, owner_col, repo_col).filter(F.size("spans") > 0)
    edits = written_side(spans.dropDuplicates([id_col, "text_key"]).select(F.col(id_col).alias("__id"), "text_key", "spans"), "secret-edits")
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, by = f"c{names.index(text_col)}", f"c{names.index(id_col)}"
    hit = flat.join(edits, F.col(by).eqNullSafe(F.col("__id")) & (F.coalesce(F.xxhash64(at), F.lit(0)) == F.col("text_key")), "left")
    # overlapping spans of different kinds: a span that starts inside the last one widens the cut only
    step = F.aggregate(
        F.col("spans"),
        F.struct(F.lit(0).cast("long").alias("upto"), F.lit("").alias("made")),
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            F.when(s["start"] < a["upto"], a["made"]).otherwise(
                F.concat(a["made"], F.col(at).substr((a["upto"] + 1).cast("int"), (s["start"] - a["upto"]).cast("int")), F.lit("<"), s["kind"], F.lit(":"), s["verdict"], F.lit(">"))
            ).alias("made"),
        ),
    )
    text = F.when(F.col("spans").isNull(), F.col(at)).otherwise(F.concat(step["made"], F.expr(f"substring({at}, cast(array_max(spans.end) as int) + 1)")))
    return hit.withColumn(at, text).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
