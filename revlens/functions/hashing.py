"""Seeded, engine-independent row ordering.

``md5(cast(id as string) || ':' || seed)`` gives the same hex string in Spark
and in DuckDB, so a seeded sample or split can be re-derived by SQL.  Its
leading hex digits sort like the full string, which lets the sampling
operators cut the hash space into ordered buckets (16**digits of them).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from revlens.functions._cols import as_col

DEFAULT_SEED = 42


def seeded_hash(id_col: Column | str, seed: int = DEFAULT_SEED) -> Column:
    return F.md5(F.concat(as_col(id_col).cast("string"), F.lit(f":{int(seed)}")))


def hash_bucket(hash_col: Column | str, digits: int = 4) -> Column:
    """Leading ``digits`` hex characters of the hash (ordered like the hash)."""
    return F.substring(as_col(hash_col), 1, digits)
