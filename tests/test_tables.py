"""Written tables and what is left on disk by writing them."""

import time

from pyspark.sql import functions as F

from lumenprep.tables import CLEANUP, drop, save


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_save_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    counts = spark.range(20000).groupBy((F.col("id") % 700).alias("k")).count()
    both = counts.join(counts.withColumnRenamed("count", "again").hint("merge"), "k")
    out = save(both, "test")
    for _ in range(50):
        if left := shuffle_files(spark) - before:
            time.sleep(0.1)
    assert not left and spark.conf.get(CLEANUP, None) == setting
    assert out.count() == 700 and both.count() == 700
    drop(out)
