"""Column expressions.  Every function returns a native Spark ``Column``
(no Python UDF), so the work stays inside whole-stage codegen."""

from revlens.functions.sentiment import rating_to_sentiment, sentiment_name
from revlens.functions.text import (
    add_label_prefix,
    normalize_for_training,
    strip_label_prefix,
    tokenize_text,
    tokens_of,
    word_count,
    word_ngrams,
)
from revlens.functions.hashing import hash_bucket, seeded_hash

__all__ = [
    "rating_to_sentiment", "sentiment_name", "add_label_prefix",
    "normalize_for_training", "strip_label_prefix", "tokenize_text",
    "tokens_of", "word_count", "word_ngrams", "hash_bucket", "seeded_hash",
]
