"""Search in transcript text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import search_hit, snippet


def search(segments: DataFrame, query: str, order: list[str], text: str = "text", limit: int | None = 50) -> DataFrame:
    """First hits in document order with a highlighted snippet; the filter runs in the scan."""
    hits = segments.where(search_hit(text, query)).withColumn("snippet", snippet(text, query))
    return hits.orderBy(*order).limit(limit) if limit else hits
