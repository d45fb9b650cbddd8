from __future__ import annotations

import time

from pyspark.sql import functions as F

from closebook.llm import storage


def shuffle_files(spark) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return sum("shuffle_" in files.apply(k).getName() for k in range(files.size()))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = spark.conf.get(storage.SHUFFLE_CLEANUP, None)
    files = shuffle_files(spark)
    kept = spark.range(10_000).groupBy(F.expr("id % 997").alias("k")).count()
    found = storage.stored(kept, "test")
    for _ in range(50):
        if shuffle_files(spark) <= files:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= files
    assert found.count() == 997
    assert spark.conf.get(storage.SHUFFLE_CLEANUP, None) == before
