"""Joins with an explicit, checked size bound for broadcasting.

A side is broadcast only after an action proved its size in bytes (rows
times fixed width, plus the text it holds); beyond the bound the join stays a
shuffle join -- salted for one-row-per-key lookup tables, otherwise left to
AQE's skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def size_in_bytes(df: DataFrame) -> int:
    """Rows times 16 bytes a column and 16 a row, plus the bytes of texts."""
    texts = [F.octet_length(f"`{f.name}`") for f in df.schema
             if isinstance(f.dataType, (StringType, BinaryType))]
    own = F.lit(0).cast("bigint")
    for t in texts:
        own = own + F.coalesce(t, F.lit(0))
    n, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(own), F.lit(0))).first()
    return n * 16 * (len(df.columns) + 1) + text


def fits(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return size_in_bytes(df) <= max_bytes


def salted_lookup_join(big: DataFrame, lookup: DataFrame, key: str, spread_col: str,
                       how: str = "left", salts: int = 32) -> DataFrame:
    """Join a skewed ``big`` side to a one-row-per-key ``lookup`` table that
    is too large to broadcast.

    Each ``big`` row gets a salt from ``spread_col`` (e.g. the document id),
    so one hot key is spread over ``salts`` reducers; the lookup side is
    replicated ``salts`` times, which is cheap because it holds one row per
    key.
    """
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(spread_col), F.lit(salts)))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_lookup, [key, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, lookup: DataFrame, key: str, spread_col: str,
                how: str = "left", max_bytes: int = DEFAULT_BROADCAST_BYTES,
                salts: int = 32) -> DataFrame:
    """Broadcast the lookup table when it proved small, else a salted join."""
    if fits(lookup, max_bytes):
        return big.join(F.broadcast(lookup), key, how)
    return salted_lookup_join(big, lookup, key, spread_col, how, salts)


LOCAL_COPY_ROWS = 100_000
LOCAL_COPY_TEXT = 64 * 1024 * 1024  # characters of all strings of a local copy


def small_local_copy(df: DataFrame, max_rows: int = LOCAL_COPY_ROWS):
    """Materialise a small aggregate once.

    One job reads at most ``max_rows + 1`` rows.  If that proves the table
    small (in rows and in the text they hold), it comes back as a local table -- no lineage, safe to
    broadcast, nothing recomputed -- and ``(df_local, rows)`` is returned.
    Otherwise the table is written to the shared checkpoint folder and
    ``(df_checkpointed, None)`` is returned: callers then join by shuffle.
    """
    rows = df.limit(max_rows + 1).collect()
    text = sum(len(v) for r in rows for v in r if isinstance(v, (str, bytes)))
    if len(rows) <= max_rows and text <= LOCAL_COPY_TEXT:
        return df.sparkSession.createDataFrame(rows, df.schema), rows
    from revlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True), None
