"""Reading the corpus tables, and what every operator shares."""

from __future__ import annotations

import os
import sys
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

import revlens
from revlens.session import scratch_path

#: Bytes of one Arrow batch handed to a Python worker (whole rows are kept
#: together, so a single longer text still travels whole).
BATCH_BYTES = 16 * 1024 * 1024
BATCH_ROWS = 2000

#: Spark removes an execution's shuffle files at its end while this is set.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes and rows, and let workers import this package.

    The package is sent along only when the workers' PYTHONPATH lacks it.
    """
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")  # collected tables stay columns
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(revlens.__file__)))
    app = spark.sparkContext.applicationId
    if app in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    home = os.path.join(spark.sparkContext._temp_dir, f"revlens-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(home, "w") as z:
        for folder, _, names in os.walk(os.path.dirname(os.path.abspath(revlens.__file__))):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    keep = list(sys.path)
    spark.sparkContext.addPyFile(home)
    sys.path[:] = keep
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    The lineage ends at the written files, so a lost executor costs no
    recomputation, and later passes read only these rows.  The shuffle files
    behind them go at once: kept until the driver collects its garbage, those
    of all passes would add up.  The session's setting stays as it was.
    """
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        scratch_path(spark, "checkpoint")
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a query takes the setting of when it is made
    finally:
        spark.conf.set(_CLEAN, before)
