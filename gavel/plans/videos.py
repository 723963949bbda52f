"""Finding the videos of a meeting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import dates_in_title, iso_duration_seconds, title_dates
from ..functions.rules import LEGACY_TERMS, SEARCH_TERMS
from ..functions.video import chapters_of, session_rank, title_part_session
from ..operators.keyed import keep_or_all

MIN_SECONDS = 600


def search_terms(spark) -> DataFrame:
    """(label, term, priority): the main term first, then the legacy ones."""
    rows = [(label, term, 0) for label, term in SEARCH_TERMS.items()]
    rows += [(label, term, i + 1) for label, terms in LEGACY_TERMS.items() for i, term in enumerate(terms)]
    return spark.createDataFrame(rows, "label string, term string, priority int")


def parsed(listing: DataFrame) -> DataFrame:
    """Raw listing (video_id, title, description, published_at, duration) with derived columns."""
    ps = title_part_session("title")
    return listing.select(
        "*",
        ps["part"].alias("part"),
        ps["session"].alias("session"),
        iso_duration_seconds("duration").alias("duration_sec"),
        chapters_of("description").alias("chapters"),
    )


def candidates(meetings: DataFrame, listing: DataFrame, terms: DataFrame) -> DataFrame:
    """Videos published from one day before to four days after, whose title holds the date and a term.

    Per meeting only the first term that finds anything counts.  Very short videos
    are dropped, unknown lengths kept.
    meetings: meeting_id, date, label.
    """
    long_enough = parsed(listing).where(F.col("duration_sec").isNull() | (F.col("duration_sec") >= MIN_SECONDS))
    # the title names the day, so the day is the join key and the interval a filter on top
    spread = long_enough.withColumn("date", F.explode(dates_in_title("title")))
    published = F.to_date("published_at")
    near = meetings.join(spread, "date").where(
        (published >= F.date_sub("date", 1)) & (published <= F.date_add("date", 4))
    )
    dated = near.where(F.exists(title_dates("date"), lambda s: F.col("title").contains(s)))
    # the term table is a fixed handful of rows
    with_term = dated.join(F.broadcast(terms), "label").where(F.lower("title").contains(F.lower("term")))
    first = with_term.groupBy("meeting_id").agg(F.min("priority").alias("priority"))
    return with_term.join(first, ["meeting_id", "priority"]).dropDuplicates(["meeting_id", "video_id"])


def of_session(found: DataFrame, label: str = "label", session: str = "session") -> DataFrame:
    """Evening meetings keep evening videos, daytime ones the rest; never down to nothing."""
    evening = F.coalesce(F.col(session) == "evening", F.lit(False))
    keep = (
        F.when(F.col(label).isNull() | F.col(label).isin("CRA", "Special"), F.lit(True))
        .when(F.col(label) == "Evening", evening)
        .otherwise(~evening)
    )
    return keep_or_all(found, ["meeting_id"], keep)


def ordered(found: DataFrame) -> DataFrame:
    return found.orderBy("meeting_id", "part", session_rank("session"), "video_id")


def find(meetings: DataFrame, listing: DataFrame) -> DataFrame:
    terms = search_terms(meetings.sparkSession)
    return ordered(of_session(candidates(meetings, listing, terms)))
