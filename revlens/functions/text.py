"""Text column functions: word count, normalisation, tokenisation, labels.

All of them are chains of native string/regex/array expressions.  A rule of
the tokeniser starts with the character it is about and looks back from
there, so most positions of a text fail on one comparison; the DuckDB
statement says the same with groups.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from revlens.functions._cols import as_col

LABEL_PREFIX = "__label__"

# Treebank-style splitting rules, applied in this order.
# (pattern, replacement) with Java-style group references; ``None`` pads the
# end of the text with one space (so a final contraction is followed by
# whitespace).  The first rule pads "...", "--" and single punctuation.
TOKEN_RULES = [
    (r"\.\.\.|--|[;@#$%&?!()\[\]{}<>]", " $0 "),
    (r":([^0-9]|$)", " : $1"),
    (r"\.(?<=[^.\s]\.)(\s|$)", " . $1"),
    None,
    (r"('(?<=[^'\s]')(?:s|m|d|ll|re|ve)?|n't(?<=[^'\s]n't))\s", " $1 "),
    (r"\bcannot\b", "can not"),
    (r"\s+", " "),
]

# Characters removed before training.
TRAINING_STRIP = r'[,"]'


def word_count(body: Column | str) -> Column:
    """Pieces of a literal single-space split: ``''`` -> 1, ``'a  b '`` -> 4.

    Counted as (spaces + 1) instead of materialising the split array; the
    result equals ``size(split(body, ' ', -1))`` and is null for null input.
    """
    b = as_col(body)
    spaces = F.length(b) - F.length(F.replace(b, F.lit(" "), F.lit("")))
    return (spaces + F.lit(1)).cast("bigint")


def normalize_for_training(body: Column | str) -> Column:
    """Delete commas and double quotes, lower-case.  Null stays null."""
    return F.lower(F.regexp_replace(as_col(body), TRAINING_STRIP, ""))


def tokenize_text(body: Column | str, normalize: bool = True) -> Column:
    """Tokenised text as one space-joined string (punctuation and English
    contractions split off)."""
    s = normalize_for_training(body) if normalize else as_col(body)
    for rule in TOKEN_RULES:
        if rule is None:
            s = F.concat(s, F.lit(" "))
        else:
            s = F.regexp_replace(s, rule[0], rule[1])
    return F.trim(s)


def tokens_of(tokenized: Column | str) -> Column:
    """Array of tokens of a tokenised string; empty text -> empty array.

    The input is referenced once, so the (costly) tokeniser chain behind it
    is evaluated once per row.
    """
    return F.array_remove(F.split(as_col(tokenized), " "), "")


def explode_tokens(tokens: Column | str) -> Column:
    """``explode_outer``: unlike ``explode`` it lets Catalyst infer no
    ``size(tokens) > 0`` filter, which would be pushed below joins with the
    whole tokeniser inlined (evaluated on every scanned row, twice).
    Callers drop the null row of an empty array where they need to."""
    return F.explode_outer(as_col(tokens))


def word_ngrams(tokens: Column | str, n: int) -> Column:
    """Contiguous ``n``-grams (space-joined) of a token array; shorter arrays
    give an empty array."""
    w = as_col(tokens)
    grams = F.transform(
        F.sequence(F.lit(1), F.size(w) - F.lit(n - 1)),
        lambda i: F.array_join(F.slice(w, i, n), " "),
    )
    return F.when(F.size(w) >= n, grams).otherwise(F.array().cast("array<string>"))


def add_label_prefix(label: Column | str) -> Column:
    """``__label__<value>``; an existing prefix is not doubled."""
    v = as_col(label).cast("string")
    return F.concat(F.lit(LABEL_PREFIX), F.replace(v, F.lit(LABEL_PREFIX), F.lit("")))


def strip_label_prefix(label: Column | str) -> Column:
    """Remove a leading ``__label__`` (a true prefix, not a character set)."""
    return F.regexp_replace(as_col(label), "^" + LABEL_PREFIX, "")
