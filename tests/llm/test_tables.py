"""Written cuts: same rows, and no shuffle files behind them."""

import glob
import os
import time

from pyspark.sql import functions as F

from revlens.llm.tables import cut


def shuffle_files(spark):
    tops = (os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")).split(",")
    return {f for top in tops for deep in ("", "*/") for f in glob.glob(f"{top}/{deep}blockmgr-*/*/shuffle_*")}


def counted(spark):
    rows = spark.range(300).withColumn("k", F.col("id") % 7)
    return rows.groupBy("k").count().repartition(3, "k").join(rows.withColumnRenamed("k", "other"), F.col("k") == F.col("id"))


def test_cut_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting)
    df = counted(spark)
    held = cut(df)
    deadline = time.time() + 10
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(setting) == was
    assert held.columns == df.columns
    assert sorted(held.collect()) == sorted(df.collect()) == sorted(counted(spark).collect())


def test_cut_takes_columns_of_one_name(spark):
    rows = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long").toDF("a.b", "a.b")
    assert sorted(map(tuple, cut(rows).collect())) == [(1, 2), (3, 4)]
