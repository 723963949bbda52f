"""The display functions and table functions under SQL names.

    register(spark)
    spark.sql("SELECT id, readable_date(date), c.* FROM videos, LATERAL chapters_in(description) AS c")

Scalar functions and the table functions over plain text have SQL bodies, so Catalyst inlines them; only rows of
HTML tables need Python, and come from a table function that parses one page at a time.  Patterns and labels are those of
the Column functions.  Null arguments give null, or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.html import ROWS_DDL, page_rows
from .money import AMOUNT
from .rules import TYPE_LABELS


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\'") + "'"


def _labels() -> str:
    return " ".join(f"WHEN '{slug}' THEN '{label}'" for slug, label in TYPE_LABELS.items())


_BLANK = r"^[\\s\\u00A0]+|[\\s\\u00A0]+$"

SCALARS = {
    "meeting_type_label(slug STRING) RETURNS STRING": f"CASE slug {_labels()} ELSE slug END",
    "readable_date(d DATE) RETURNS STRING": "date_format(d, 'EEEE, MMMM d, yyyy')",
    "short_date(d DATE) RETURNS STRING": "date_format(d, 'MMM d, yyyy')",
    "thumbnail_url(id STRING) RETURNS STRING": "concat('https://img.youtube.com/vi/', nullif(id, ''), '/mqdefault.jpg')",
    "clean_title(title STRING) RETURNS STRING": f"coalesce(regexp_replace(regexp_replace(title, '(?i)^File No\\\\.\\\\s*[A-Z0-9-]+\\\\s*\\\\n?', ''), '{_BLANK}', ''), '')",
    "has_content(body STRING) RETURNS BOOLEAN": f"coalesce(length(regexp_replace(body, '{_BLANK}', '')) > 0, false)",
    "watch_url(id STRING, seconds BIGINT) RETURNS STRING": "concat('https://youtu.be/', id, '?t=', seconds)",
    # the last part that starts at or before the segment, else the first one
    "seek_in_videos(sec BIGINT, videos ARRAY<STRUCT<part: INT, start_sec: BIGINT, offset_seconds: DOUBLE>>) RETURNS STRUCT<seconds: DOUBLE, part: INT>": (
        "CASE WHEN sec IS NOT NULL AND size(videos) > 0 THEN transform(array(coalesce("
        "array_max(transform(filter(videos, v -> v.start_sec <= sec), v -> struct(v.start_sec AS s, -v.part AS p, v.offset_seconds AS o))), "
        "struct(videos[0].start_sec AS s, -videos[0].part AS p, videos[0].offset_seconds AS o))), "
        "b -> struct(greatest(0D, b.o + (sec - b.s)) AS seconds, -b.p AS part))[0] END"
    ),
}
TABLES = {
    # one generator over the whole array, so that the function becomes part of the caller's scan
    "chapters_in(description STRING) RETURNS TABLE (chapter_no INT, title STRING, clock STRING, seconds BIGINT)": r"""
        SELECT pos, col.title, col.clock,
               CASE size(col.parts) WHEN 2 THEN try_cast(col.parts[0] AS BIGINT) * 60 + try_cast(col.parts[1] AS BIGINT)
                    WHEN 3 THEN try_cast(col.parts[0] AS BIGINT) * 3600 + try_cast(col.parts[1] AS BIGINT) * 60 + try_cast(col.parts[2] AS BIGINT)
                    ELSE 0 END
        FROM posexplode(transform(
            filter(transform(split(description, '\n'), x -> trim(x)), x -> x RLIKE '^\\d+(?::\\d+)+\\s+\\S'),
            x -> struct(trim(regexp_extract(x, '^(\\d+(?::\\d+)+)\\s+(.+)$', 2)) AS title, regexp_extract(x, '^(\\d+(?::\\d+)+)\\s+(.+)$', 1) AS clock,
                        split(regexp_extract(x, '^(\\d+(?::\\d+)+)\\s+(.+)$', 1), ':') AS parts)))""",
    "amounts_in(body STRING) RETURNS TABLE (amount_no INT, amount STRING)": f"SELECT pos, col FROM posexplode(regexp_extract_all(body, {_quoted(AMOUNT)}, 0))",
}


class HtmlTableRows:
    """Rows of the tables of one page."""

    def eval(self, html: str | None) -> Iterator[tuple]:
        yield from page_rows(html)


def register(spark: SparkSession) -> None:
    """Make all functions known to SQL of this session; doing it again changes nothing."""
    for signature, body in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    for signature, body in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    spark.udtf.register("html_table_rows", F.udtf(HtmlTableRows, returnType=ROWS_DDL))
