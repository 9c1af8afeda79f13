"""Catalog operations: database, CSV-backed table, listing and describing.

Everything is plain Spark SQL DDL against the session catalog; table and
database names are bound with ``IDENTIFIER(:name)``, never spliced into text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.sources.csv_io import CSV_READ_OPTIONS

# Declared column types of the registered review table.
REVIEW_TABLE_COLUMNS = {"sentiment": "int", "review_body": "string", "product_category": "string"}


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Idempotent; ``location`` pins the database folder (otherwise the
    session's warehouse folder is used)."""
    if location:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db) LOCATION :loc",
                  args={"db": name, "loc": location})
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": name})


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def register_csv_table(spark: SparkSession, database: str, table: str, path: str,
                       columns_types: dict | None = None, sep: str = ",",
                       skip_header: bool = True) -> str:
    """(Re)register a headed CSV folder as an external table with fixed types.

    ``CREATE OR REPLACE`` is not accepted for CSV tables of the session
    catalog, so the table is dropped first.
    """
    columns_types = columns_types or REVIEW_TABLE_COLUMNS
    full = f"{database}.{table}"
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": full})
    cols = ", ".join(f"`{c}` {t}" for c, t in columns_types.items())
    options = dict(CSV_READ_OPTIONS)
    options.update({"header": "true" if skip_header else "false", "sep": sep, "path": path})
    opts = ", ".join(f"'{k}' :{k.replace('.', '_')}" for k in options)
    spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({cols}) USING csv OPTIONS ({opts})",
              args={"t": full, **{k.replace('.', '_'): v for k, v in options.items()}})
    return full


def describe_table(spark: SparkSession, full_name: str) -> DataFrame:
    return spark.sql("DESCRIBE TABLE IDENTIFIER(:t)", args={"t": full_name})
