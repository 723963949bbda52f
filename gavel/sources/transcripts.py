"""Transcript pages: header fields and speaker segments, row-local on the line array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import indexes, islands, let, strip

SPEAKER_LINE = r"^(\d{1,2}:\d{2}:\d{2}[AP]M)\s+>>([^:]+):(.*)$"
STAMPED_LINE = r"^\d{1,2}:\d{2}:\d{2}[AP]M\s+>>"
STAMP = r"^\d{1,2}:\d{2}:\d{2}[AP]M"


def header_fields(lines: Column, title_marker: str) -> Column:
    """Struct(meeting_title, meeting_date_time, disclaimer) of the first 20 lines."""
    return let(lines, lambda ls: _header(ls, F.slice(ls, 1, 20), title_marker))


def _header(lines: Column, head: Column, title_marker: str) -> Column:
    stop = F.array_position(F.transform(head, lambda x: F.when(x.contains("DISCLAIMER:"), 1).otherwise(0)), 1).cast("int")
    before = F.slice(head, 1, F.when(stop > 0, stop - 1).otherwise(F.size(head)))
    titles = F.filter(before, lambda x: x.contains(title_marker))
    dates = F.filter(before, lambda x: x.rlike(r"^[A-Z]+DAY,") & ~x.contains(title_marker))
    after = F.slice(lines, stop + 1, 9)
    end = F.array_position(F.transform(after, lambda x: F.when(x.rlike(STAMP), 1).otherwise(0)), 1).cast("int")
    said = F.slice(after, 1, F.when(end > 0, end - 1).otherwise(F.size(after)))
    return F.struct(
        F.try_element_at(titles, F.lit(-1)).alias("meeting_title"),
        F.try_element_at(dates, F.lit(-1)).alias("meeting_date_time"),
        F.when(stop > 0, F.array_join(said, " ")).alias("disclaimer"),
    )


def speaker_segments(lines: Column, boilerplate: tuple[str, ...] = ("Skip to",), keep_opening: bool = True) -> Column:
    """Segments of (timestamp, speaker, text).

    A speaker line opens a segment; what stands before the first is dropped, as are
    stamped lines without a speaker, boilerplate and segments without text.
    `keep_opening=False` drops the text that follows the colon on the opening line.
    """

    def is_noise(x):
        noise = x.rlike(STAMPED_LINE) & ~x.rlike(SPEAKER_LINE)
        for b in boilerplate:
            noise = noise | x.startswith(b)
        return noise

    def segment(block):
        opening = F.element_at(block, 1)
        rest = F.filter(F.slice(block, 2, F.size(block)), lambda x: ~is_noise(x))
        said = strip(F.regexp_extract(opening, SPEAKER_LINE, 3))
        first = F.when(F.lit(keep_opening) & (F.length(said) > 0), F.array(said)).otherwise(F.array().cast("array<string>"))
        return F.struct(
            F.regexp_extract(opening, SPEAKER_LINE, 1).alias("timestamp"),
            strip(F.regexp_extract(opening, SPEAKER_LINE, 2)).alias("speaker"),
            F.array_join(F.concat(first, rest), " ").alias("text"),
        )

    def cut(ls):
        starts = F.filter(indexes(ls), lambda i: F.get(ls, i).rlike(SPEAKER_LINE))
        return F.filter(F.transform(islands(ls, starts), segment), lambda s: F.length(s["text"]) > 0)

    return let(lines, cut)


def parse_pages(pages: DataFrame, lines: Column, keep: list[str], title_marker: str, **options) -> DataFrame:
    """Transcript documents from pages."""
    with_lines = pages.withColumn("_lines", lines)
    return (
        with_lines.select(
            *keep,
            header_fields(F.col("_lines"), title_marker).alias("h"),
            speaker_segments(F.col("_lines"), **options).alias("segments"),
        )
        .select(*keep, "h.*", "segments")
        .withColumn("segment_count", F.size("segments"))
    )
