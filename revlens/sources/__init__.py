"""Readers, writers, catalog helpers and the test-data stand-in views."""

from revlens.sources.tables import load_table, order_reviews, reviews
from revlens.sources.csv_io import (
    read_clean_reviews,
    read_raw_reviews,
    write_clean_csv,
    write_labelled_text,
    write_training_projection,
)
from revlens.sources.config import BiasConfig, read_bias_config

__all__ = [
    "load_table", "order_reviews", "reviews", "read_clean_reviews",
    "read_raw_reviews", "write_clean_csv", "write_labelled_text",
    "write_training_projection", "BiasConfig", "read_bias_config",
]
