"""Spreading a scan over tasks before heavy per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_scan(df: DataFrame) -> DataFrame:
    """Rows of a plain scan over at least as many partitions as there are cores.

    Only a scan with fewer splits than cores is moved (a few small files); a large
    input already has more splits than cores and stays as it is, without a shuffle.
    Meant for scans with projections and filters, not for plans with shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def spread_rows(df: DataFrame, rows: int) -> DataFrame:
    """Rows of a plain scan over tasks of about `rows` rows, and at least as many as there are cores.

    Well compressed files hold very many rows in one split, so that the longest task would grow with the input; the
    count comes from the files' footers.  A scan that has as many splits is not moved."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
