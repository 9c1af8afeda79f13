"""CSV and text readers/writers for review files.

The raw file has a header, an unnamed leading index column and types that
the reference infers.  A user schema on CSV binds by *position* and the
column order of the raw file is not fixed, so every column is read as a
string, selected by name, and cast with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.functions.text import add_label_prefix
from revlens.sources.quoted_csv import read_quoted_csv

# Spellings that pandas' CSV reader turns into a missing value.
NA_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Quote-aware options: quoted commas, doubled quotes and embedded newlines.
CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _reader(spark: SparkSession, sep: str = ","):
    reader = spark.read.format("csv").option("sep", sep)
    for k, v in CSV_READ_OPTIONS.items():
        reader = reader.option(k, v)
    return reader


def null_if_na(col: str) -> F.Column:
    c = F.col(f"`{col}`")
    return F.when(c.isin(*NA_SPELLINGS), F.lit(None).cast("string")).otherwise(c)


def read_raw_reviews(spark: SparkSession, path: str, index_column: bool = True,
                     splittable: bool = False) -> DataFrame:
    """Raw headed CSV; the first (index) column is dropped, NA spellings are
    null, every other column stays a string (cast later by name).

    ``splittable`` reads large files by many tasks (``quoted_csv``); without
    it a file, whose quoted cells may hold newlines, is one task's work."""
    df = _reader(spark).load(path)
    if splittable:
        df = read_quoted_csv(spark, path, df.columns)
    cols = df.columns[1:] if index_column else df.columns
    return df.select([null_if_na(c).alias(c) for c in cols])


def read_clean_reviews(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Cleaned/balanced review CSV with a header: typed by name."""
    df = _reader(spark, sep).load(path)
    out = []
    for c in df.columns:
        col = null_if_na(c)
        if c in ("sentiment", "id"):
            col = col.try_cast("bigint" if c == "id" else "int")
        out.append(col.alias(c))
    return df.select(out)


def _writer(df: DataFrame, mode: str):
    w = df.write.mode(mode).format("csv")
    for k, v in CSV_WRITE_OPTIONS.items():
        w = w.option(k, v)
    return w


def write_clean_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV without index (one file per partition, written by the executors)."""
    _writer(df, mode).save(path)


def write_training_projection(df: DataFrame, path: str, label_col: str = "sentiment",
                              text_col: str = "review_body", mode: str = "overwrite") -> None:
    write_clean_csv(df.select(label_col, text_col), path, mode)


def labelled_lines(df: DataFrame, label_col: str = "sentiment",
                   text_col: str = "review_body", prefixed: bool = False,
                   keep=()) -> DataFrame:
    """``__label__<y> <tokenised text>`` lines (no quoting of the text);
    ``keep`` columns are carried in front of ``value``."""
    label = F.col(label_col) if prefixed else add_label_prefix(label_col)
    return df.select(*keep, F.concat_ws(" ", label, F.col(text_col)).alias("value"))


def write_labelled_text(df: DataFrame, path: str, label_col: str = "sentiment",
                        text_col: str = "review_body", prefixed: bool = False,
                        mode: str = "overwrite") -> None:
    """Space-separated, header-less training text (one line per review)."""
    labelled_lines(df, label_col, text_col, prefixed).write.mode(mode).text(path)
