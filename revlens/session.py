"""Session helpers.

Library code never creates its own session: every operator takes the
DataFrame it works on.  ``local_session`` is for tests, the bench and the
command line only.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "revlens", driver_memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS / object store)
    folder and is used as is.  Only when nothing is configured (local tests)
    is a scratch folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is not visible to other executors and
            # dies with the node: refuse instead of checkpointing into it.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        configured = tempfile.mkdtemp(prefix="revlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


#: Bytes of a Parquet row group and rows of a read batch where rows are long:
#: writers and readers hold one of them per task.
GROUP_BYTES, READ_ROWS = 16 * 1024 * 1024, 256
_READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """What is planned inside reads Parquet by ``READ_ROWS`` rows; the session's
    setting stays as it was."""
    before = spark.conf.get(_READ_ROWS)
    spark.conf.set(_READ_ROWS, str(READ_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_READ_ROWS, before)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written (compressed) to a fresh folder of the shared checkpoint
    folder and read from there, and the folder.  The shuffle files behind it go
    at once (Spark 4.1; older versions ignore the setting)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.select("*").write.parquet(path)  # a query takes the setting of when it is made
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``written`` made."""
    sc = spark.sparkContext
    home = sc._jvm.org.apache.hadoop.fs.Path(path)
    home.getFileSystem(sc._jsc.hadoopConfiguration()).delete(home, True)


_SHIPPED: set[str] = set()

#: Rows and bytes of one Arrow batch handed to a Python worker (a longer row
#: still travels whole).
BATCH_ROWS, BATCH_BYTES = 2000, 16 * 1024 * 1024


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: it is sent along once per
    application unless the workers' PYTHONPATH already holds it.  Arrow batches
    are bounded, so a worker's memory doesn't grow with its partition."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    package = os.path.dirname(os.path.abspath(__file__))
    root, sc = os.path.dirname(package), spark.sparkContext
    if sc.applicationId in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    home = os.path.join(sc._temp_dir, f"package-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(home, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    before = list(sys.path)
    sc.addPyFile(home)
    sys.path[:] = before  # the driver goes on importing from the folder
    _SHIPPED.add(sc.applicationId)
