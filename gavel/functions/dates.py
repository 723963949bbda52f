"""Dates, wall clocks and durations; every bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, capture, col

DAY = 86_400
WALL_CLOCK = r"(?i)(\d{1,2}):(\d{2}):(\d{2})\s*(AM|PM)"


def wall_clock_seconds(clock: ColumnLike, allow_no_seconds: bool = False) -> Column:
    """'9:06:03AM' -> seconds of day; null when it is not a wall clock."""
    t = F.upper(F.trim(col(clock)))
    pattern = r"^(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(AM|PM)$" if allow_no_seconds else r"^(\d{1,2}):(\d{2}):(\d{2})\s*(AM|PM)$"
    part = lambda i: F.expr("cast(null as string)") if i is None else capture(t, pattern, i)
    h, m, half = part(1).cast("int"), part(2).cast("int"), part(4)
    s = F.coalesce(part(3).cast("int"), F.lit(0))
    valid = half.isNotNull() & h.between(1, 12) & (m < 60) & (s < 60)
    return F.when(valid, ((h % 12) + F.when(half == "PM", 12).otherwise(0)) * 3600 + m * 60 + s)


def clock_or_elapsed_seconds(text: ColumnLike) -> Column:
    """Wall clock, or elapsed h:mm:ss / mm:ss without a half-day mark."""
    t = F.trim(col(text))
    parts = F.split(t, ":")
    numeric = t.rlike(r"^\d+(:\d{1,2}){1,2}$")
    n = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    elapsed = (
        F.when(numeric & (F.size(parts) == 2), n(1) * 60 + n(2))
        .when(numeric & (F.size(parts) == 3), n(1) * 3600 + n(2) * 60 + n(3))
    )
    return F.coalesce(wall_clock_seconds(text), elapsed)


def wrapped_difference(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Seconds from earlier to later on a 24 h clock."""
    return F.pmod(col(later) - col(earlier), F.lit(DAY))


def iso_duration_seconds(duration: ColumnLike) -> Column:
    """'PT3H7M21S' -> seconds; null for anything that is not a duration."""
    d = col(duration)
    unit = lambda u: F.coalesce(capture(d, rf"^PT.*?(\d+){u}").try_cast("int"), F.lit(0))
    return F.when(d.rlike(r"^PT(\d+H)?(\d+M)?(\d+S)?$"), unit("H") * 3600 + unit("M") * 60 + unit("S"))


def parse_date(text: ColumnLike) -> Column:
    """M/D/YYYY anywhere, ISO, 'Month D, YYYY' or 'Weekday, Month D, YYYY'."""
    t = F.trim(col(text))
    no_day = F.regexp_replace(t, r"^(?i)(Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,\s*", "")
    as_date = lambda x, p: F.try_to_timestamp(x, F.lit(p)).cast("date")
    return F.coalesce(
        as_date(capture(t, r"(\d{1,2}/\d{1,2}/\d{4})"), "M/d/yyyy"),
        as_date(capture(t, r"^(\d{4}-\d{2}-\d{2})$"), "yyyy-MM-dd"),
        as_date(F.initcap(F.lower(capture(no_day, r"^([A-Za-z]{4,9} \d{1,2}, \d{4})$"))), "MMMM d, yyyy"),
        as_date(F.initcap(F.lower(capture(no_day, r"^([A-Za-z]{3} \d{1,2}, \d{4})$"))), "MMM d, yyyy"),
    )


def date_from_name(file_name: ColumnLike) -> Column:
    return F.try_to_timestamp(capture(file_name, r"(\d{4}-\d{2}-\d{2})"), F.lit("yyyy-MM-dd")).cast("date")


def resolve_date(formatted: ColumnLike, spoken: ColumnLike, file_name: ColumnLike) -> Column:
    """Formatted date, else the spoken one, else the one in the file name."""
    return F.coalesce(parse_date(formatted), parse_date(spoken), date_from_name(file_name))


def date_in_text(text: ColumnLike) -> Column:
    """First date of a page text: after a weekday, numeric, or any 'Month D, YYYY'."""
    spoken = capture(text, r"(?i)(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,\s+([A-Za-z]+\s+\d{1,2},\s+\d{4})")
    return F.coalesce(
        parse_date(F.regexp_replace(spoken, r"\s+", " ")),
        parse_date(capture(text, r"(\d{1,2}/\d{1,2}/\d{4})")),
        parse_date(F.regexp_replace(capture(text, r"([A-Za-z]+\s+\d{1,2},\s+\d{4})"), r"\s+", " ")),
    )


def date_in_summary(text: ColumnLike) -> Column:
    """Date of a summary sheet: 'Requested Meeting Date' before 'Meeting Date'."""
    return F.coalesce(
        parse_date(capture(text, r"(?i)Requested Meeting Date:\s*(\d{1,2}/\d{1,2}/\d{4})")),
        parse_date(capture(text, r"(?i)Meeting Date:\s*(\d{1,2}/\d{1,2}/\d{4})")),
    )


def readable_date(date: ColumnLike) -> Column:
    return F.date_format(col(date), "EEEE, MMMM d, yyyy")


def long_date(date: ColumnLike) -> Column:
    return F.date_format(col(date), "MMMM d, yyyy")


def short_date(date: ColumnLike) -> Column:
    return F.date_format(col(date), "MMM d, yyyy")


def month_bucket(date: ColumnLike) -> Column:
    return F.date_format(col(date), "yyyy-MM")


def title_dates(date: ColumnLike) -> Column:
    """The eight spellings under which a date may stand in a video title."""
    d = col(date)
    patterns = [p.replace("/", sep) for sep in ("/", "-") for p in ("MM/dd/yyyy", "M/d/yyyy", "MM/dd/yy", "M/d/yy")]
    return F.array(*[F.date_format(d, p) for p in patterns])


def dates_in_title(title: ColumnLike) -> Column:
    """Every date some spelling of which may stand in the title, one digit cut off included.

    A superset for joining on the day; `title_dates` decides afterwards.
    """
    long = F.regexp_extract_all(col(title), F.lit(r"(?=(\d{1,2}([/-])\d{1,2}\2\d{4}))"), F.lit(1))
    short = F.regexp_extract_all(col(title), F.lit(r"(?=(\d{1,2}([/-])\d{1,2}\2\d{2}))"), F.lit(1))
    day = lambda x, p: F.try_to_timestamp(F.replace(x, F.lit("-"), F.lit("/")), F.lit(p)).cast("date")
    every = F.concat(F.transform(long, lambda x: day(x, "M/d/yyyy")), F.transform(short, lambda x: day(x, "M/d/yy")))
    return F.array_distinct(F.filter(every, lambda d: d.isNotNull()))


# The sampling-window rule, in seconds.
DEFAULT_WINDOW = 600
NO_CHAPTER_WINDOW = 900
CHAPTER_BUFFER = 120
PRE_ROLL = 300
MATCH_BUFFER = 180
SKIP_MARGIN = 300
PRE_CHAPTER_MARGIN = 120
MORNING_FROM, MORNING_UNTIL, MORNING_START = 8 * 3600, 12 * 3600, 9 * 3600
EVENING_START = 17 * 3600


def sampling_window(part: ColumnLike, first_speech: ColumnLike, second_chapter: ColumnLike) -> Column:
    """Struct(start, duration) of the audio that is worth listening to.

    `first_speech` is the second of day of the first segment, `second_chapter`
    the start of the second chapter; either may be null.
    """
    p, speech, chapter = F.coalesce(col(part), F.lit(1)), col(first_speech), col(second_chapter)
    pair = lambda s, d: F.struct(F.lit(s).cast("bigint").alias("start") if not isinstance(s, Column) else s.cast("bigint").alias("start"), F.lit(d).cast("bigint").alias("duration") if not isinstance(d, Column) else d.cast("bigint").alias("duration"))
    scheduled = (
        F.when((speech >= MORNING_FROM) & (speech < MORNING_UNTIL), MORNING_START)
        .when(speech >= EVENING_START, EVENING_START)
    )
    expected = F.greatest(speech - scheduled + PRE_ROLL, chapter)
    first_part = (
        F.when(expected.isNull() | scheduled.isNull(), pair(0, DEFAULT_WINDOW))
        .when(expected > DEFAULT_WINDOW, pair(expected - SKIP_MARGIN, SKIP_MARGIN + MATCH_BUFFER))
        .otherwise(pair(0, F.greatest(F.lit(DEFAULT_WINDOW), expected + MATCH_BUFFER)))
    )
    later_part = (
        F.when(chapter.isNull(), pair(0, NO_CHAPTER_WINDOW))
        .when(chapter > PRE_CHAPTER_MARGIN, pair(chapter - PRE_CHAPTER_MARGIN, PRE_CHAPTER_MARGIN + MATCH_BUFFER))
        .otherwise(pair(0, F.greatest(F.lit(DEFAULT_WINDOW), chapter + CHAPTER_BUFFER)))
    )
    return F.when(p == 1, first_part).otherwise(later_part)
