"""What a stored table leaves on the disks of the executors."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from gavel import session


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            names.add(name)
    return names


def test_shuffle_files_go_with_the_write(spark):
    before = _shuffle_files(spark)
    summed = spark.range(100_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.sum("id").alias("s"))
    table = session.stored(summed)
    for _ in range(50):  # the files are removed behind the query
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session.FILE_CLEANUP) == "false"
    assert table.count() == summed.count() == 5000 and table.agg(F.sum("s")).first()[0] == 99_999 * 50_000
