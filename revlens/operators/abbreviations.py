"""Abbreviations found in a corpus, and tokens that keep their period.

A word that nearly always carries a final period is an abbreviation: the
log-likelihood of "the period belongs to it" against "periods fall on words
as often as anywhere", from counts over all texts, scaled down for long words,
for words also seen without a period, and up for inner periods (Kiss and
Strunk 2006).  All of it is one count per word and native expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revlens.functions.text import explode_tokens

#: A token's word (letters, with single periods inside) and its final period.
WORD = r"^[^\p{L}]*(\p{L}+(?:\.\p{L}+)*)(\.?)[^\p{L}.]*$"
# The published chance of a period behind an abbreviation, and
# the least scaled score.
ABBREVIATION_PERIOD, LEAST_SCORE = 0.99, 0.3
#: Most abbreviations that go into a tokenising expression.
MOST = 10_000


def abbreviation_scores(df: DataFrame, text_col: str = "review_body") -> DataFrame:
    """(word, n_period, n_plain, score) of every word seen with a final period.

    Words are lower-cased tokens between white space without what surrounds
    them; tokens with several periods in a row, digits inside or without
    letters count nowhere.  Null texts hold no words.  The score is null where
    every word of the corpus has a period.
    """
    token = explode_tokens(F.split(F.lower(text_col), r"\s+"))
    words = (df.select(token.alias("t"))
             .select(F.regexp_extract("t", WORD, 1).alias("word"), (F.regexp_extract("t", WORD, 2) == ".").alias("period"))
             .where("word <> ''"))
    counts = words.groupBy("word").agg(F.count(F.when(F.col("period"), 1)).alias("n_period"),
                                       F.count(F.when(~F.col("period"), 1)).alias("n_plain"))
    all_ = counts.agg(F.sum("n_period").alias("_periods"), F.sum(F.col("n_period") + F.col("n_plain")).alias("_all"))
    held = counts.where("n_period > 0").crossJoin(F.broadcast(all_))  # one row of totals
    share = F.col("_periods") / F.col("_all")
    by_chance = F.col("n_period") * F.ln(share) + F.col("n_plain") * F.ln(1 - share)
    bound = (F.col("n_period") * F.ln(F.lit(ABBREVIATION_PERIOD)) + F.col("n_plain") * F.ln(F.lit(1 - ABBREVIATION_PERIOD)))
    letters = F.length(F.replace(F.col("word"), F.lit("."), F.lit(""))).cast("double")
    inner = F.length("word") - letters
    score = (-2 * (by_chance - bound)) * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("n_plain").cast("double"))
    return held.select("word", "n_period", "n_plain", F.when(share < 1, score).alias("score"))


def abbreviations(scores: DataFrame, least: float = LEAST_SCORE, most: int = MOST) -> list[str]:
    """The abbreviations of a score table, in order; more than ``most`` is an error."""
    rows = scores.where(F.col("score") >= least).select("word").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} abbreviations")
    return sorted(r["word"] for r in rows)


def keep_abbreviation_periods(df: DataFrame, words: list[str], tokens_col: str = "tokens") -> DataFrame:
    """``df`` with the period that the tokeniser split from an abbreviation
    put back, except at the end of the text, where it also ends the sentence."""
    if not words:
        return df
    known, t = F.array(*[F.lit(w) for w in words]), F.col(tokens_col)
    last = F.size(t) - 1

    def joined(token, i):
        ahead = (i < last - 1) & (F.get(t, i + 1) == ".")
        taken = (token == ".") & (i > 0) & (i < last) & F.array_contains(known, F.get(t, i - 1))
        return (F.when(ahead & F.array_contains(known, token), F.concat(token, F.lit(".")))
                .when(taken, F.lit(None).cast("string")).otherwise(token))
    return df.withColumn(tokens_col, F.filter(F.transform(t, joined), lambda x: x.isNotNull()))
