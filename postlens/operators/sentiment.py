"""Lexicon sentiment as a Spark job.

Plan shape (per call, all text columns at once, one evaluation of the input)::

    posts -> explode tokens, the row itself on its first token -> join lexicon, keep hits and firsts
      -> partial+final aggregate by the row's 32-byte hash -> as many rows as there were

Rows are told apart by the SHA-256 of all they hold (carried columns and texts). Only that hash goes
with every token; the carried columns go once, with the row's first token. Equal rows have equal
scores, so they may share a group: the sums are divided by the number of rows and that many rows come
out. No id needs to be unique or present, nothing depends on row order, and there is no join back.
Tokens come from one ``split`` of the text, by generated code: no function is called per token.

The lexicon is an input table ``(token string, valence double)``; repeated tokens are rejected. Spark
broadcasts it by its byte threshold, else plans a shuffle join. Valences are summed as DECIMAL so the
score does not depend on task order.

Scores per text column ``c``:
  * ``c-sentiment-compound`` = round(s / sqrt(s^2 + 15), 4), s = sum of valences;
    no hit, empty or null text gives 0.0.
  * with ``keep_struct``: ``c-sentiment`` = struct(neg, neu, pos, compound) where
    pos = sum(v+1 | v>0), neg = |sum(v-1 | v<0)|, neu = tokens with valence 0
    (tokens outside the lexicon count as 0), each divided by their total and
    rounded to 3; no tokens gives all zeros.
Tokens are runs of a-z, lower-cased. With ``marks``, a piece between white space that isn't such a run
(an emoticon, say) is a token too where the lexicon holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, VariantType

from .. import constants as K
from ..errors import LexiconError
from ..functions.text import TOKEN_SPLIT, col_of
from .projection import require_columns

VALENCE_TYPE = "decimal(18,6)"
REPEAT_STEP = 1_000_000


def lexicon_frame(spark, entries) -> DataFrame:
    """Lexicon from ``[(token, valence), ...]``."""
    from ..sources.files import local_frame
    return local_frame(spark, [(str(t), float(v)) for t, v in entries], "token string, valence double")


def check_unique(words: DataFrame, col: str, what: str) -> None:
    """One distributed count; only the first repeated word comes to the driver."""
    again = words.groupBy(col).count().filter("count > 1").limit(1).collect()
    if again:
        raise LexiconError(f"{what} repeats a token (would double-count): {again[0][0]}")


def checked_lexicon(lexicon: DataFrame) -> DataFrame:
    """Validate (non-empty, unique tokens) and return lower-cased tokens with decimal valences."""
    lex = lexicon.select(F.lower(F.col("token")).alias("token"),
                         F.col("valence").cast(VALENCE_TYPE).alias("valence"))
    if lex.isEmpty():
        raise LexiconError("lexicon is empty")
    check_unique(lex, "token", "lexicon")
    return lex.filter(F.col("valence") != 0)


def _as_string(c, kind) -> Column:
    """A value as text that is equal for equal values only."""
    if isinstance(kind, StringType):
        return c
    return F.to_json(F.struct(c.alias("v"))) if isinstance(kind, (StructType, ArrayType, MapType, VariantType)) else c.cast("string")


def row_hash(df: DataFrame, cols) -> Column:
    """32 bytes that tell apart rows which differ in any of ``cols``."""
    parts = [_as_string(col_of(c), df.schema[c].dataType) for c in dict.fromkeys(cols)]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256))


def row_of(carry, extra=()) -> Column:
    """The carried columns as one struct with positional names, so that no carried name can clash."""
    return F.struct(*[col_of(c).alias(f"c{i}") for i, c in enumerate(carry)], *extra, F.lit(True).alias("here"))


def on_first(pos: str, row: str) -> list[Column]:
    """``_first`` for a row's first token, and ``_row`` there alone."""
    first = F.coalesce(F.col(pos), F.lit(0)) == 0
    return [first.alias("_first"), F.when(first, F.col(row)).alias("_row")]


def sources(sizes) -> tuple[list[Column], Column]:
    """Where each text's tokens begin in the joined array, and which text a position ``_pos`` is in."""
    begins = [F.lit(0)]
    for size in sizes[:-1]:
        begins.append(begins[-1] + F.col(size))
    src = F.lit(0)
    for begin in begins[1:]:
        src = src + (F.col("_pos") >= begin).cast("int")
    return begins, src


def repeated(df: DataFrame, n: str) -> DataFrame:
    """Each row as many times as its column ``n`` says, in steps of bounded arrays; drops ``n``."""
    k = F.col(n)
    steps = df.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((k - 1) / REPEAT_STEP).cast("long"))))
    left = F.least(k - F.col("_step") * REPEAT_STEP, F.lit(REPEAT_STEP).cast("long"))
    return steps.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("_step", "_copy", n)


def _compound(s):
    sd = s.cast("double")
    return F.coalesce(F.round(sd / F.sqrt(sd * sd + F.lit(K.COMPOUND_ALPHA)), 4), F.lit(0.0))


def _share(part, total):
    # round through a decimal so exact ties round half-up on the decimal value
    share = F.round(F.abs(part / total).cast("decimal(20,10)"), 3).cast("double")
    return F.when(total > 0, share).otherwise(F.lit(0.0))


def sentiment(df: DataFrame, lexicon: DataFrame, text_cols=("full_text", "user-description"),
              key: str | None = None, sent: str = "sentiment", compound: str = "compound",
              keep_struct: bool = False, sep: str = "-", marks: bool = False) -> DataFrame:
    """Add ``<col><sep><sent><sep><compound>`` (and optionally the struct) per text column.

    Every input row is kept, with any ids; ``key`` is accepted for older callers and not used.
    """
    return sentiment_carry(df, lexicon, text_cols, None, sent, compound, sep, keep_struct, marks)


def sentiment_carry(df: DataFrame, lexicon: DataFrame, text_cols=("full_text",), carry=None,
                    sent: str = "sentiment", compound: str = "compound", sep: str = "-",
                    keep_struct: bool = False, marks: bool = False) -> DataFrame:
    """The ``carry`` columns (default: all) and the scores of ``text_cols``, one row per input row."""
    carry = list(df.columns if carry is None else carry)
    text_cols = list(text_cols)
    require_columns(df, text_cols + carry)
    lex = checked_lexicon(lexicon)
    each = range(len(text_cols))
    low = [F.lower(F.coalesce(col_of(c), F.lit(""))) for c in text_cols]
    words = [F.split(t, TOKEN_SPLIT) for t in low]
    pieces = [F.concat(w, F.split(t, r"\s+")) if marks else w for w, t in zip(words, low, strict=True)]
    base = df.select(row_hash(df, carry + text_cols).alias("_key"), row_of(carry).alias("_all"),
                     *[w.alias(f"_word{i}") for i, w in enumerate(words)], *[p.alias(f"_tok{i}") for i, p in enumerate(pieces)])
    # the split leaves an empty string at a text's ends at most
    count = [F.size(f"_word{i}") - (F.get(f"_word{i}", F.lit(0)) == "").cast("int")
             - ((F.size(f"_word{i}") > 1) & (F.element_at(f"_word{i}", -1) == "")).cast("int") for i in each]
    base = base.select("_key", "_all", F.concat(*[F.col(f"_tok{i}") for i in each]).alias("_tok"),
                       *[F.size(f"_tok{i}").alias(f"_size{i}") for i in each],
                       *[F.size(f"_word{i}").alias(f"_words{i}") for i in each], *[n.alias(f"_z{i}") for i, n in enumerate(count)])
    begins, src = sources([f"_size{i}" for i in each])
    ex = base.select("*", F.posexplode_outer("_tok").alias("_pos", "token")).withColumn("_src", src)
    kept = ["_key", *on_first("_pos", "_all"), "_src", "token", *[f"_z{i}" for i in each]]
    if marks:  # pieces that are words are there already
        at = F.lit(False)
        for i in each:
            at = at | ((F.col("_src") == i) & (F.col("_pos") >= begins[i] + F.col(f"_words{i}")))
        ex = ex.withColumn("token", F.when(at & F.col("token").rlike("^[a-z]*$"), F.lit("")).otherwise(F.col("token")))
    joined = ex.select(*kept).join(lex, "token", "left").filter(F.col("valence").isNotNull() | F.col("_first"))
    v = F.col("valence")
    aggs = [F.count_if("_first").alias("_n"), F.first("_row", ignorenulls=True).alias("_row")]
    for i in each:
        own = F.col("_src") == F.lit(i)
        aggs.append(F.sum(F.when(own, v)).alias(f"_s{i}"))
        if keep_struct:
            aggs += [F.sum(F.when(own & (v > 0), v + 1)).alias(f"_p{i}"), F.sum(F.when(own & (v < 0), v - 1)).alias(f"_m{i}"),
                     F.count_if(own & v.isNotNull()).alias(f"_h{i}"), F.max(f"_z{i}").alias(f"_z{i}")]
    agg = repeated_sums(joined.groupBy("_key").agg(*aggs))
    out = [F.col(f"_row.c{i}").alias(c) for i, c in enumerate(carry)]
    for i, c in enumerate(text_cols):
        comp = _compound(F.col(f"_s{i}"))
        if keep_struct:
            pos = F.coalesce(F.col(f"_p{i}").cast("double"), F.lit(0.0))
            neg = F.coalesce(F.col(f"_m{i}").cast("double"), F.lit(0.0))
            neu = F.greatest(F.col(f"_z{i}") - F.coalesce(F.col(f"_h{i}"), F.lit(0)), F.lit(0)).cast("double")
            total = pos + F.abs(neg) + neu
            out.append(F.struct(_share(neg, total).alias("neg"), _share(neu, total).alias("neu"),
                                _share(pos, total).alias("pos"), comp.alias("compound")).alias(f"{c}{sep}{sent}"))
        out.append(comp.alias(f"{c}{sep}{sent}{sep}{compound}"))
    return agg.select(*out)


def repeated_sums(agg: DataFrame) -> DataFrame:
    """Group sums over ``_n`` equal rows become those of one row, which comes out ``_n`` times."""
    shared = [c for c in agg.columns if c[:2] in ("_s", "_p", "_m", "_h") and c[2:].isdigit()]
    return repeated(agg.withColumns({c: F.col(c) / F.col("_n") for c in shared}), "_n")
