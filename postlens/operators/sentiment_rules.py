"""Rule-based lexicon sentiment (context rules on top of the level-0 score).

Rules, per lexicon hit at token position i (after Hutto & Gilbert, 2014):
  * all-caps emphasis: a hit written in capitals, in a text that mixes
    capitalised and other words, moves 0.733 away from zero;
  * boosters in the three preceding tokens (only those not in the lexicon)
    add their scalar (sign follows the running valence, +/-0.733 more when the
    booster is in capitals in a mixed text), damped by 0.95 and 0.9 at
    distances two and three;
  * a negation word (or any word containing ``n't``) in those positions
    multiplies the running valence by -0.74; in its place, "never so" or
    "never this" from distance two multiplies by 1.5, and at distance three
    ("never so/this" there, or "so"/"this" right before the hit) by 1.25;
  * idioms: of the phrases of the idiom table that contain the hit, the
    longest (then the one that begins first) sets the running valence;
  * a booster of two words ("kind of") one or two tokens before the hit lowers
    the valence by 0.293; the word "kind" followed by "of" scores 0;
  * "least" before the hit, not after "at" or "very", multiplies by -0.74;
  * a hit before the first "but" is halved, after it is multiplied by 1.5;
  * booster words themselves score 0.
Per text: s = sum of hit valences; ``!`` adds 0.292 each up to four, two or
three ``?`` add 0.18 each and more add 0.96, moved away from zero; compound =
s / sqrt(s^2 + 15), clamped to [-1, 1] and rounded to 4. Shares: pos = sum(v+1
| v>0), neg = sum(v-1 | v<0) (punctuation added to the larger side),
neu = tokens without a non-zero score; each over their total, rounded to 3.

Tokens: whitespace split, punctuation stripped from the edges unless that
leaves two characters or fewer (so emoticons stay whole and may stand in the
lexicon), tokens of one character dropped.

Plan: the texts are cleaned by two regular expressions and split once; the "but"
position, capitals and punctuation counts are per row. Only hits (and each row's
first token) go on from the lexicon join and take their neighbours from a slice
of the row's token array. One word table (lexicon + boosters + negations) is joined
four times (the hit and three neighbours); each phrase length and offset of the
idiom table is an equi-join of the phrase around the hit. One aggregate over the
row's hash follows (see ``sentiment``): ids may repeat or be null. Valences are
summed as DECIMAL, so scores don't depend on task order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import LexiconError
from ..functions.text import col_of
from .projection import require_columns
from .sentiment import check_unique, on_first, repeated_sums, row_hash, row_of, sources

# FIXED VALUES: rule constants.
CAPS_INCREMENT = 0.733
NEGATION_SCALAR = -0.74
DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
BUT_BEFORE = 0.5
BUT_AFTER = 1.5
EXCLAIM_STEP = 0.292
EXCLAIM_MAX = 4
QUESTION_STEP = 0.18
QUESTION_MANY = 0.96
ALPHA = 15.0

# FIXED VALUES: words of the special cases.
NEVER, STRESS, STRESS_NEAR, STRESS_FAR = "never", ("so", "this"), 1.5, 1.25
LEAST, LEAST_AFTER = "least", ("at", "very")
PAIR_SHIFT = -0.293

_PUNCT = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
SUM_TYPE = "decimal(20,10)"


def word_table(lexicon: DataFrame, boosters: DataFrame | None = None, negations: DataFrame | None = None) -> DataFrame:
    """``(w, valence, scalar, neg)`` from lexicon ``(token, valence)``, boosters
    ``(token, scalar)`` and negations ``(token)``; validated."""
    empty = {"valence": "double", "scalar": "double", "neg": "boolean"}

    def part(table: DataFrame, **own) -> DataFrame:
        w = F.lower("token").alias("w")
        return table.select(w, *[own.get(c, F.lit(None)).cast(t).alias(c) for c, t in empty.items()])

    parts = [("lexicon", part(lexicon, valence=F.col("valence")))]
    if boosters is not None:
        parts.append(("boosters", part(boosters, scalar=F.col("scalar"))))
    if negations is not None:
        parts.append(("negations", part(negations, neg=F.lit(True))))
    if lexicon.isEmpty():
        raise LexiconError("lexicon is empty")
    whole = parts[0][1]
    for name, t in parts:
        check_unique(t, "w", name)
        whole = whole if name == "lexicon" else whole.unionByName(t)
    return whole.groupBy("w").agg(F.max("valence").alias("valence"), F.max("scalar").alias("scalar"),
                                  F.coalesce(F.max("neg"), F.lit(False)).alias("neg"))


def phrase_table(phrases: DataFrame, value: str, what: str) -> DataFrame:
    """``(phrase, value)`` with lower-cased words and single spaces; repeated phrases are rejected."""
    t = phrases.select(F.btrim(F.regexp_replace(F.lower(F.col("phrase")), r"\s+", " ")).alias("phrase"), F.col(value).cast("double").alias(value))
    check_unique(t, "phrase", what)
    return t


def _clean(text):
    """The text as tokens between white space, edge punctuation and one-character tokens gone."""
    core = rf"(?<!\S){_PUNCT}*((?!{_PUNCT})\S\S+\S(?<!{_PUNCT})){_PUNCT}*(?!\S)"
    stripped = F.regexp_replace(F.coalesce(text, F.lit("")), core, "$1")
    return F.btrim(F.regexp_replace(stripped, r"(?<!\S)\S(?!\S)", ""), F.lit(" \t\n\x0b\f\r"))


_BUT = r"(?<!\S)but(?!\S)"
# a token in capitals, and one that isn't, in a cleaned text
_CAPITAL = r"(?<!\S)[^\p{Ll}\p{Lt}\s]*\p{Lu}[^\p{Ll}\p{Lt}\s]*(?!\S)"
_NO_CAPITAL = r"(?<!\S)(?:\S*[\p{Ll}\p{Lt}]\S*|[^\p{Lu}\s]+)(?!\S)"


def _is_upper(c):
    return (F.upper(c) == c) & (F.lower(c) != c)


def _count_char(text, ch):
    t = F.coalesce(text, F.lit(""))
    return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))


def _observed(hits: DataFrame, what: str) -> DataFrame:
    """``hits``, their number as an observed metric. Spark generates the code before and after it apart, so that
    no method that runs once a token or hit passes the 8,000 bytes beyond which the JVM only interprets it."""
    return hits.observe(f"sentiment_rules hits {what} {uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def sentiment_rules(df: DataFrame, lexicon: DataFrame, boosters: DataFrame | None = None,
                    negations: DataFrame | None = None, text_cols=("full_text", "user-description"),
                    key: str | None = None, sent: str = "sentiment", compound: str = "compound",
                    keep_struct: bool = False, sep: str = "-", carry=None, idioms: DataFrame | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) and ``<col><sep><sent><sep><compound>`` (optionally the
    struct) with the context rules, one row per input row; ``key`` is accepted and not used.

    ``boosters``: (token, scalar), a token of two words being a pair; ``idioms``: (phrase, valence)."""
    carry, text_cols = list(df.columns if carry is None else carry), list(text_cols)
    require_columns(df, text_cols + carry)
    pairs = None
    if boosters is not None:
        pair = F.col("token").rlike(r"\S\s+\S")
        pairs = phrase_table(boosters.filter(pair).select(F.col("token").alias("phrase"), "scalar"), "scalar", "boosters")
        boosters, pairs = boosters.filter(~pair), None if pairs.isEmpty() else pairs
    info = word_table(lexicon, boosters, negations)
    each = range(len(text_cols))
    counts = []
    for i, c in enumerate(text_cols):
        counts += [_count_char(col_of(c), "!").alias(f"b{i}"), _count_char(col_of(c), "?").alias(f"q{i}")]
    pre = df.select(row_hash(df, carry + text_cols).alias("_key"), row_of(carry, counts).alias("_all"),
                    *[_clean(col_of(c)).alias(f"_t{i}") for i, c in enumerate(text_cols)])
    # the tokens are split once; "but" is looked for by its word first, which few texts hold
    but = lambda t: F.when(F.lower(t).rlike(_BUT), F.array_position(F.split(F.lower(t), r"\s+"), F.lit("but"))).otherwise(F.lit(0))
    pre = pre.select("_key", "_all", *[F.split(f"_t{i}", r"\s+").alias(f"_w{i}") for i in each],
                     *[(F.col(f"_t{i}") == "").alias(f"_e{i}") for i in each], *[but(F.col(f"_t{i}")).alias(f"_but{i}") for i in each],
                     *[(F.col(f"_t{i}").rlike(_CAPITAL) & F.col(f"_t{i}").rlike(_NO_CAPITAL)).alias(f"_caps{i}") for i in each])
    joined = F.col("_w0") if len(text_cols) == 1 else F.concat(*[F.col(f"_w{i}") for i in each])
    pre = pre.select("_key", "_all", joined.alias("_own"), *[F.size(f"_w{i}").alias(f"_size{i}") for i in each], *[f"_caps{i}" for i in each],
                     *[F.when(F.col(f"_e{i}"), 0).otherwise(F.size(f"_w{i}")).alias(f"_z{i}") for i in each], *[f"_but{i}" for i in each])
    begins, src = sources([f"_size{i}" for i in each])

    def of_source(values):
        out = values[0]
        for i in each[1:]:
            out = F.when(F.col("src") >= i, values[i]).otherwise(out)
        return out

    ex = pre.select("*", F.posexplode_outer("_own").alias("_pos", "own")).withColumn("src", src)
    ex = ex.withColumns({"begin": of_source(begins), "end": of_source([b + F.col(f"_size{i}") for i, b in enumerate(begins)])})
    longest = 0
    if idioms is not None:
        idioms = phrase_table(idioms, "valence", "idioms").withColumn("words", F.size(F.split("phrase", " ")))
        longest = idioms.agg(F.max("words")).first()[0] or 0
    around = {d: f"f{d}" for d in range(1, longest)} | {-d: f"p{d}" for d in range(1, max(4, longest))} | {1: "f1"}
    # the tokens around, of the same text; they are read for hits only
    low, high = F.greatest(F.col("begin"), F.col("_pos") + min(around)), F.least(F.col("end"), F.col("_pos") + max(around) + 1)
    ex = ex.select("_key", *on_first("_pos", "_all"), *[f"_z{i}" for i in each], "src", F.lower("own").alias("w"),
                   (F.col("_pos") - F.col("begin") + 1).alias("pos"), of_source([F.col(f"_but{i}") for i in each]).alias("but"),
                   of_source([F.col(f"_caps{i}") for i in each]).alias("_mixed"), F.slice("_own", low + 1, high - low).alias("_near"),
                   (F.col("_pos") - low).alias("_mid"))
    hits = ex.join(info.select("w", "valence", F.col("scalar").alias("self_scalar")), "w", "left") \
        .filter(F.col("valence").isNotNull() | F.col("_first"))
    hits = _observed(hits, "found")
    at = lambda d: F.get("_near", F.col("_mid") + d)
    hits = hits.withColumns({n: F.lower(at(d)) for d, n in around.items()}
                            | {f"u{d}": F.col("_mixed") & _is_upper(at(-d)) for d in (0, 1, 2, 3)}).drop("_near", "_mid", "_mixed")
    for d in (1, 2, 3):
        nb = info.select(F.col("w").alias(f"p{d}"), F.col("valence").isNotNull().alias(f"v{d}"),
                         F.col("scalar").alias(f"s{d}"), F.col("neg").alias(f"n{d}"))
        hits = hits.join(nb, f"p{d}", "left")
    v = F.col("valence")
    hits = hits.withColumn("_v", v + F.when(F.col("u0"), F.when(v > 0, F.lit(CAPS_INCREMENT)).otherwise(F.lit(-CAPS_INCREMENT))).otherwise(F.lit(0.0)))
    stress = {d: F.coalesce(F.col(f"p{d}").isin(*STRESS), F.lit(False)) for d in (1, 2)}
    never = {d: F.coalesce(F.col(f"p{d}") == NEVER, F.lit(False)) for d in (2, 3)}
    for d in (1, 2, 3):
        cur = F.col("_v")
        applies = F.col(f"p{d}").isNotNull() & ~F.coalesce(F.col(f"v{d}"), F.lit(False))
        # a booster's own scalar, with more where it is in capitals, both by the sign of the valence
        shift = F.col(f"s{d}") * F.when(cur < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        shift = shift + F.when(F.col(f"u{d}"), F.when(cur > 0, F.lit(CAPS_INCREMENT)).otherwise(F.lit(-CAPS_INCREMENT))).otherwise(F.lit(0.0))
        boosted = cur + F.coalesce(shift * F.lit(DAMPING[d]), F.lit(0.0))
        negated = F.coalesce(F.col(f"n{d}"), F.lit(False)) | F.col(f"p{d}").contains("n't")
        nxt = F.when(negated, boosted * NEGATION_SCALAR).otherwise(boosted)
        if d == 2:
            nxt = F.when(never[2] & stress[1], boosted * STRESS_NEAR).otherwise(nxt)
        if d == 3:
            nxt = F.when(never[3] & stress[2] | stress[1], boosted * STRESS_FAR).otherwise(nxt)
        hits = hits.withColumn("_v", F.when(applies, nxt).otherwise(cur))
    hits = _observed(hits, "scored")
    for n in range(longest, 1, -1):  # the longest first, then the one that begins first
        some = idioms.filter(F.col("words") == n)
        for first in range(1 - n, 1):
            words = [F.col("w") if d == 0 else F.col(around[d]) for d in range(first, first + n)]
            phrase = F.when(words[0].isNotNull() & words[-1].isNotNull(), F.concat_ws(" ", *words))
            name = f"i{n}_{first + n - 1}"
            found = some.select(F.col("phrase").alias(f"_{name}"), F.col("valence").alias(name))
            hits = hits.withColumn("_phrase", phrase).join(found, F.col("_phrase") == F.col(f"_{name}"), "left").drop("_phrase", f"_{name}")
    spans = [F.col(f"i{n}_{first + n - 1}") for n in range(longest, 1, -1) for first in range(1 - n, 1)]
    if spans:
        hits = hits.withColumn("_v", F.when(F.col("valence").isNotNull(), F.coalesce(*spans, "_v"))).drop(*[f"i{n}_{f + n - 1}" for n in range(longest, 1, -1) for f in range(1 - n, 1)])
    if pairs is not None:
        for a in (2, 3):
            two = F.when(F.col(f"p{a}").isNotNull(), F.concat_ws(" ", f"p{a}", f"p{a - 1}"))
            hits = hits.withColumn("_two", two).join(pairs.select(F.col("phrase").alias("_two"), F.col("scalar").alias(f"_pair{a}")), "_two", "left").drop("_two")
        lowered = F.col("_pair2").isNotNull() | F.col("_pair3").isNotNull()
        hits = hits.withColumn("_v", F.when(lowered, F.col("_v") + PAIR_SHIFT).otherwise(F.col("_v")))
    after = F.coalesce(F.col("p2").isin(*LEAST_AFTER), F.lit(False))
    least = F.coalesce(F.col("p1") == LEAST, F.lit(False)) & ~F.coalesce(F.col("v1"), F.lit(False)) & ~after
    hits = hits.withColumn("_v", F.when(least, F.col("_v") * NEGATION_SCALAR).otherwise(F.col("_v")))
    but_w = (F.when(F.col("but") > 0, F.when(F.col("pos") < F.col("but"), F.lit(BUT_BEFORE))
                    .when(F.col("pos") > F.col("but"), F.lit(BUT_AFTER)).otherwise(F.lit(1.0)))
             .otherwise(F.lit(1.0)))
    still = F.col("self_scalar").isNotNull() | F.coalesce((F.col("w") == "kind") & (F.col("f1") == "of"), F.lit(False))
    hits = hits.withColumn("_v", F.when(still, F.lit(0.0)).otherwise(F.col("_v") * but_w))
    vv = F.col("_v").cast(SUM_TYPE)
    aggs = [F.count_if("_first").alias("_n"), F.first("_row", ignorenulls=True).alias("_row")]
    for i in each:
        own = F.col("src") == F.lit(i)
        aggs += [F.sum(F.when(own, vv)).alias(f"_s{i}"),
                 F.sum(F.when(own & (vv > 0), vv + 1)).alias(f"_p{i}"),
                 F.sum(F.when(own & (vv < 0), vv - 1)).alias(f"_m{i}"),
                 F.count_if(own & (vv != 0)).alias(f"_h{i}"), F.max(f"_z{i}").alias(f"_z{i}")]
    agg = repeated_sums(hits.groupBy("_key").agg(*aggs))
    out = [F.col(f"_row.c{i}").alias(c) for i, c in enumerate(carry)]
    for i, c in enumerate(text_cols):
        n_tok = F.col(f"_z{i}")
        bang = F.least(F.col(f"_row.b{i}"), F.lit(EXCLAIM_MAX)) * F.lit(EXCLAIM_STEP)
        q = F.col(f"_row.q{i}")
        qm = F.when(q <= 1, F.lit(0.0)).when(q <= 3, q * F.lit(QUESTION_STEP)).otherwise(F.lit(QUESTION_MANY))
        punct = bang + qm
        s = F.coalesce(F.col(f"_s{i}").cast("double"), F.lit(0.0))
        s = F.when(s > 0, s + punct).when(s < 0, s - punct).otherwise(s)
        comp = F.round(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), s / F.sqrt(s * s + F.lit(ALPHA)))), 4)
        comp = F.when(n_tok > 0, comp).otherwise(F.lit(0.0))
        if keep_struct:
            ps = F.coalesce(F.col(f"_p{i}").cast("double"), F.lit(0.0))
            ns = F.coalesce(F.col(f"_m{i}").cast("double"), F.lit(0.0))
            ps2 = F.when(ps > F.abs(ns), ps + punct).otherwise(ps)
            ns2 = F.when(ps < F.abs(ns), ns - punct).otherwise(ns)
            neu = (n_tok - F.coalesce(F.col(f"_h{i}"), F.lit(0))).cast("double")
            total = ps2 + F.abs(ns2) + neu

            def share(x, total=total):
                return F.when(total > 0, F.round(F.abs(x / total).cast("decimal(20,10)"), 3).cast("double")) \
                    .otherwise(F.lit(0.0))
            out.append(F.struct(share(ns2).alias("neg"), share(neu).alias("neu"), share(ps2).alias("pos"),
                                comp.alias("compound")).alias(f"{c}{sep}{sent}"))
        out.append(comp.alias(f"{c}{sep}{sent}{sep}{compound}"))
    return agg.select(*out)
