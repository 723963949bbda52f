"""Link columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, blank_to_null, col


def absolute_url(url: ColumnLike, base: str) -> Column:
    u = blank_to_null(url)
    return F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(base), F.replace(u, F.lit("&amp;"), F.lit("&"))))


def direct_download(url: ColumnLike) -> Column:
    """Viewer link -> byte link, once."""
    u = col(url)
    rewritten = F.regexp_replace(u, r"^(.*?)DownloadFile", "$1DownloadFileBytes")
    return F.when(u.contains("DownloadFileBytes"), u).otherwise(rewritten)


def query_param(url: ColumnLike, name: str) -> Column:
    return F.try_parse_url(col(url), F.lit("QUERY"), F.lit(name))


def viewer_url(base: str, meeting_id: ColumnLike, doctype: int = 1) -> Column:
    return F.concat(F.lit(base + "?meetingId="), col(meeting_id).cast("string"), F.lit(f"&type=agenda&doctype={doctype}"))
