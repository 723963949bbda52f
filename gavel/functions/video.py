"""Video titles and descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, capture, col, strip


def title_part_session(title: ColumnLike) -> Column:
    """Struct(part, session) read off a video title."""
    t = F.lower(col(title))
    number = capture(t, r"(?:part|pt)\s*(\d+)").try_cast("int")
    pick = lambda p, s: F.struct((p if isinstance(p, Column) else F.lit(p)).cast("int").alias("part"), F.lit(s).cast("string").alias("session"))
    return (
        F.when(number.isNotNull(), pick(number, None))
        .when(t.contains("morning"), pick(1, "morning"))
        .when(t.contains("afternoon"), pick(2, "afternoon"))
        .when(t.contains("evening"), pick(3, "evening"))
        .when(t.rlike(r"\bpm\b"), pick(1, "evening"))
        .when(t.rlike(r"\bam\b"), pick(1, "morning"))
        .when(t.contains("workshop"), pick(1, "morning"))
        .otherwise(pick(1, None))
    )


def chapters_of(description: ColumnLike) -> Column:
    """Array of struct(title, timestamp, seconds) from the lines of a description."""
    lines = F.filter(
        F.transform(F.split(col(description), "\n"), strip), lambda s: s.rlike(r"^\d+(?::\d+)+\s+\S")
    )

    def chapter(s):
        stamp = F.regexp_extract(s, r"^(\d+(?::\d+)+)\s+(.+)$", 1)
        parts = F.split(stamp, ":")
        n = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("bigint")
        seconds = (
            F.when(F.size(parts) == 2, n(1) * 60 + n(2))
            .when(F.size(parts) == 3, n(1) * 3600 + n(2) * 60 + n(3))
            .otherwise(F.lit(0))
        )
        return F.struct(
            strip(F.regexp_extract(s, r"^(\d+(?::\d+)+)\s+(.+)$", 2)).alias("title"),
            stamp.alias("timestamp"),
            seconds.cast("bigint").alias("seconds"),
        )

    return F.transform(lines, chapter)


def session_rank(session: ColumnLike) -> Column:
    s = col(session)
    return F.when(s == "morning", 1).when(s == "afternoon", 2).when(s == "evening", 3).otherwise(99)
