"""Star rating -> sentiment label, and the label legend."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from revlens.functions._cols import as_col

# Rating groups and the legend printed with predictions.
NEGATIVE_RATINGS = (1, 2)
NEUTRAL_RATING = 3
POSITIVE_RATINGS = (4, 5)
SENTIMENT_NAMES = {-1: "Negative", 0: "Neutral", 1: "Positive"}


def rating_to_sentiment(rating: Column | str) -> Column:
    """{1,2} -> -1, 3 -> 0, {4,5} -> 1; any other rating (0, 6, 4.5, null) -> null.

    No ``otherwise``: unmapped ratings stay null, like the implicit ``None``
    of a Python function without a final return.
    """
    r = as_col(rating)
    return (F.when(r.isin(*NEGATIVE_RATINGS), F.lit(-1))
            .when(r == NEUTRAL_RATING, F.lit(0))
            .when(r.isin(*POSITIVE_RATINGS), F.lit(1)))


def sentiment_name(sentiment: Column | str) -> Column:
    s = as_col(sentiment)
    expr = None
    for value, name in SENTIMENT_NAMES.items():
        expr = (F.when(s == value, F.lit(name)) if expr is None
                else expr.when(s == value, F.lit(name)))
    return expr
