"""The given tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import spread_rows, spread_scan
from ..session import skew_settings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; zone-less timestamps read as UTC timestamps."""
    skew_settings(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table with its stored types, so that filters on timestamps reach the scan."""
    skew_settings(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table for heavy per-row work: small files are spread over the cores."""
    return spread_scan(table(spark, folder, name))


#: Rows of one task, where every row is a page to parse; the given pages are larger than made ones.
PAGE_ROWS = {"pages": 4_000}
MADE_PAGE_ROWS = 100_000


def page_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table whose rows are parsed as pages: tasks stay short however many rows there are."""
    return spread_rows(table(spark, folder, name), PAGE_ROWS.get(name, MADE_PAGE_ROWS))


def event_segments(spark: SparkSession, folder: str) -> DataFrame:
    """events as segments: meeting = user, us = microseconds, sec = seconds."""
    e = table(spark, folder, "events")
    return e.select(
        F.col("user_id").alias("meeting_id"),
        "event_id",
        F.unix_micros("ts").alias("us"),
        (F.unix_micros("ts") / 1_000_000).alias("sec"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("clock"),
        "ts",
        "event_type",
        "value",
    )


def meetings(spark: SparkSession, folder: str) -> DataFrame:
    """orders as meetings, with their number of lines as item count."""
    o = table(spark, folder, "orders")
    n = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("item_count"))
    return o.join(n, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("meeting_type"),
        F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
        "o_custkey",
        "o_orderstatus",
    )
