"""What the site reads: listing, nested meetings, archive, day grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import flag_exists
from ..operators.nesting import nest_pages
from ..operators.sequence import Position, Sequence, Total


def listing(meetings: DataFrame, videos: DataFrame, since: str | None = None) -> DataFrame:
    """Meetings with content, video flag and first video, newest first."""
    df = meetings.where((F.col("item_count") > 0) | F.col("transcript_source_id").isNotNull())
    if since:
        df = df.where(F.col("date") >= F.lit(since).cast("date"))
    first = videos.groupBy(F.col("meeting_id").alias("id")).agg(
        F.min_by("video_id", F.struct("part", "video_id")).alias("first_video_id")
    )
    df = flag_exists(df, videos.select(F.col("meeting_id").alias("id")), ["id"], "has_video")
    return df.join(first, "id", "left").orderBy(F.desc("date"), "meeting_type", "id")


def items_with_documents(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Items per meeting as ordered pages, each item with its ordered documents.

    An item with more documents than a page holds comes once per `doc_page`.
    """
    docs = nest_pages(documents, ["meeting_id", "item_pos"], "doc_pos", ["title", "source_url"], "documents")
    joined = items.join(docs.withColumnRenamed("page", "doc_page"), ["meeting_id", "item_pos"], "left")
    joined = joined.withColumn("doc_page", F.coalesce("doc_page", F.lit(0).cast("bigint")))
    fields = ["item_number", "file_number", "title", "documents"]
    return nest_pages(joined, ["meeting_id", "doc_page"], "item_pos", fields, "items")


def segments_nested(segments: DataFrame) -> DataFrame:
    return nest_pages(segments, ["meeting_id"], "segment_index", ["timestamp", "speaker", "text"], "segments")


def videos_with_chapters(videos: DataFrame, chapters: DataFrame) -> DataFrame:
    """Videos per meeting as ordered pages, each with its ordered chapters (paged alike)."""
    ch = nest_pages(chapters, ["meeting_id", "video_id"], "chapter_index", ["title", "seconds"], "chapters")
    joined = videos.join(ch.withColumnRenamed("page", "chapter_page"), ["meeting_id", "video_id"], "left")
    joined = joined.withColumn("chapter_page", F.coalesce("chapter_page", F.lit(0).cast("bigint")))
    return nest_pages(joined, ["meeting_id", "chapter_page"], "part", ["video_id", "title", "chapters"], "videos")


def baselines(segments: DataFrame) -> DataFrame:
    """First clock of each transcript."""
    return segments.groupBy("meeting_id").agg(F.min_by("timestamp", "segment_index").alias("baseline"))


def by_date(meetings: DataFrame) -> DataFrame:
    """Date → meetings in id order, in pages of bounded size."""
    placed = Sequence(["date"], ["id"], ["id"]).apply(meetings.select("date", "id", "meeting_type", "title"), pos=Position())
    placed = placed.withColumn("pos", F.col("pos") - 1)
    return nest_pages(placed, ["date"], "pos", ["id", "meeting_type", "title"], "meetings")


def index_order(meetings: DataFrame, date: str, tie: str) -> DataFrame:
    """Newest first, meetings without a date last and shown as 0000-00-00."""
    shown = F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("0000-00-00"))
    return meetings.withColumn("shown_date", shown).orderBy(F.desc_nulls_last(date), tie)


def latest_and_archive(meetings: DataFrame) -> DataFrame:
    """Flag the meetings of the latest date and rank the dates newest first.

    Ranks come from the distinct dates (a day per row, so a bounded table).
    """
    dates = meetings.select("date").distinct()
    ranked = Sequence([], [F.desc("date")], ["_neg"]).apply(
        dates.withColumn("_neg", -F.unix_date("date")), date_rank=Position()
    )
    out = meetings.join(ranked.select("date", "date_rank"), "date")
    return out.withColumn("is_latest", (F.col("date_rank") == 1).cast("int"))


def combined_days(meetings: DataFrame) -> DataFrame:
    """Meetings of one day in running order (evening last, then id); addenda left out.

    The order is a position column, so a day is never collected into one row.
    """
    rows = meetings.where(~F.coalesce(F.col("is_addendum"), F.lit(False)))
    rows = rows.withColumn("_prio", F.when(F.col("meeting_type") == "evening", 1).otherwise(0))
    seq = Sequence(["date"], ["_prio", "id"], ["_prio", "id"])
    out = seq.apply(rows, position=Position(), in_day=Total(F.lit(1).cast("bigint")))
    return out.withColumn("is_multi", (F.col("in_day") > 1).cast("int")).drop("_prio")
