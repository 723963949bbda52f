"""Coverage of the collection, volume of its documents, processing summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_bucket
from ..functions.text import file_extension
from ..operators.nesting import subtotals


def coverage(meetings: DataFrame, date: str, kind: str) -> DataFrame:
    """Counts by month, by type and overall in one pass of GROUPING SETS."""
    df = meetings.select(month_bucket(date).alias("month"), F.col(kind).alias("type"), F.col(date).alias("_d"))
    out = df.groupingSets([["month"], ["type"], []], "month", "type").agg(
        F.count(F.lit(1)).alias("meetings"),
        F.min("_d").alias("first_date"),
        F.max("_d").alias("last_date"),
        F.grouping_id().cast("bigint").alias("level"),
    )
    return out.withColumn("span_days", F.datediff("last_date", "first_date"))


def document_volume(docs: DataFrame, dims: list[str], size: str, error: str | None = None, kind: str = "rollup") -> DataFrame:
    """Documents, bytes and errors with subtotals."""
    failed = F.col(error).isNotNull() if error else F.lit(False)
    return subtotals(
        docs,
        dims,
        [
            F.count(F.lit(1)).alias("documents"),
            F.coalesce(F.sum(F.when(~failed, F.col(size))), F.lit(0)).alias("bytes"),
            F.count(F.when(failed, 1)).alias("errors"),
        ],
        kind,
    )


def by_extension(docs: DataFrame, name: str, size: str) -> DataFrame:
    """Bytes per file extension (.pdf when there is none), largest first."""
    ext = F.coalesce(F.nullif(file_extension(name), F.lit("")), F.lit(".pdf"))
    totals = docs.groupBy(ext.alias("extension")).agg(F.count(F.lit(1)).alias("documents"), F.sum(size).alias("bytes"))
    return totals.orderBy(F.desc("bytes"), "extension")


def annual_projection(docs: DataFrame, date: str, size: str) -> DataFrame:
    """Yearly bytes from the weeks that were observed."""
    per_week = docs.groupBy(F.date_trunc("week", F.col(date)).alias("week")).agg(F.sum(size).alias("_b"))
    return per_week.agg(
        F.count(F.lit(1)).alias("weeks"),
        F.sum("_b").alias("bytes"),
        F.bround(F.sum("_b") / F.count(F.lit(1)) * 52, 2).alias("projected_annual_bytes"),
    )


def processing_summary(items: DataFrame, meeting: str, error: str, background: str) -> DataFrame:
    failed = F.coalesce(F.length(error) > 0, F.lit(False))
    return items.groupBy(meeting).agg(
        F.count(F.lit(1)).alias("items"),
        F.count(F.when(~failed, 1)).alias("succeeded"),
        F.count(F.when(failed, 1)).alias("failed"),
        F.count(F.when(F.length(background) > 0, 1)).alias("with_background"),
    )


def video_totals(videos: DataFrame, meeting: str, seconds: str) -> DataFrame:
    return videos.groupBy(meeting).agg(
        F.count(F.lit(1)).alias("videos"), F.coalesce(F.sum(seconds), F.lit(0)).alias("total_seconds")
    )
