"""From clock-stamped segments to positions in the right video part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DAY, wall_clock_seconds, wrapped_difference
from ..operators.ranges import asof_backward
from ..operators.sequence import Carry, First, Next, Position, Prev, Running, RunningMax, Sequence, TARGET_ROWS


def _sequence(key: str, index: str | list[str], target_rows: int = TARGET_ROWS) -> Sequence:
    """Order by one index column, or by several that make the order total (first one numeric)."""
    order = [index] if isinstance(index, str) else list(index)
    return Sequence([key], order, order, target_rows)


def detect_gaps(
    segments: DataFrame,
    key: str,
    index: str | list[str],
    clock: str,
    min_gap_minutes: float = 60.0,
    seconds: Column | None = None,
    wrap: bool = True,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Pauses strictly longer than the threshold, numbered per meeting.

    Rows whose clock does not parse are stepped over when measuring, though the
    reported end is the physically previous row.  A meeting whose first clock does
    not parse yields nothing.  `seconds` replaces the clock parser when the table
    already has numeric times (then `wrap=False` for absolute times).
    """
    base = segments.withColumn("_sec", seconds if seconds is not None else wall_clock_seconds(clock))
    seq = _sequence(key, index, target_rows).sized(segments)
    seen = seq.apply(base, _before=Carry("_sec", before=True), end_timestamp=Prev(clock), _first=First("_sec"))
    passed = wrapped_difference("_sec", "_before") if wrap else F.col("_sec") - F.col("_before")
    gaps = (
        seen.withColumn("_passed", passed)
        .where(F.col("_first").isNotNull() & (F.col("_passed") > min_gap_minutes * 60))
        .withColumn("gap_minutes", F.bround(F.col("_passed") / 60.0, 1))
        .withColumn("resume_timestamp", F.col(clock))
        .drop("_before", "_first", "_passed")
    )
    return seq.apply(gaps, gap_no=Position()).drop("_sec")


def gap_parts(gaps: DataFrame) -> DataFrame:
    """Gap k (from 1) starts video part k+1."""
    return gaps.withColumn("part", (F.col("gap_no") + 1).cast("int"))


def save_part_starts(videos: DataFrame, gaps: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Videos with transcript_start_time filled from the gaps; and gaps with no such part."""
    starts = gap_parts(gaps).select(key, "part", F.col("resume_timestamp").alias("_start"))
    filled = videos.join(starts, [key, "part"], "left").withColumn(
        "transcript_start_time", F.coalesce("_start", "transcript_start_time")
    ).drop("_start")
    unmatched = starts.join(videos.select(key, "part").distinct(), [key, "part"], "left_anti")
    return filled.select(*videos.columns), unmatched.withColumnRenamed("_start", "resume_timestamp")


def save_offsets(videos: DataFrame, offsets: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Videos with rounded offsets joined on; and offsets of unknown videos."""
    new = offsets.select(*on, F.bround("offset", 0).cast("int").alias("_offset"))
    filled = videos.join(new, on, "left").withColumn(
        "offset_seconds", F.coalesce("_offset", F.col("offset_seconds").cast("int"))
    ).drop("_offset")
    return filled.select(*videos.columns), new.join(videos.select(*on).distinct(), on, "left_anti")


def segment_durations(segments: DataFrame, key: str, index: str | list[str], seconds: str, default: int = 30) -> DataFrame:
    """Time until the next segment; the last one gets the default."""
    seq = _sequence(key, index)
    out = seq.apply(segments, _next=Next(seconds))
    return out.withColumn("duration", F.coalesce(F.col("_next") - F.col(seconds), F.lit(default))).drop("_next")


def speaker_turns(segments: DataFrame, key: str, index: str | list[str], speaker: str) -> DataFrame:
    """Number the runs of one speaker; a null speaker closes a named run."""
    seq = _sequence(key, index).sized(segments)
    marked = seq.apply(segments, _prev=Prev(F.struct(F.col(speaker).alias("s"))))
    starts = (F.col("_prev").isNull() | ~F.col("_prev.s").eqNullSafe(F.col(speaker))).cast("bigint")
    return seq.apply(marked.withColumn("_starts", starts), turn_no=Running("_starts")).drop("_prev", "_starts")


def within_search_window(
    segments: DataFrame, key: str, index: str | list[str], seconds: str, limit_seconds: int = 1200, at_least: int = 10
) -> DataFrame:
    """Segments up to the first one past the limit after the baseline, but at least `at_least`."""
    seq = _sequence(key, index).sized(segments)
    base = seq.apply(segments, _base=First(seconds), _pos=Position())
    late = (F.col(seconds) - F.col("_base") > limit_seconds).cast("int")
    marked = seq.apply(base.withColumn("_late", late), _passed=RunningMax("_late"))
    kept = (F.coalesce(F.col("_passed"), F.lit(0)) == 0) | (F.col("_pos") <= at_least)
    return marked.where(kept).drop("_base", "_pos", "_late", "_passed")


def restrict_to_part(segments: DataFrame, parts: DataFrame, key: str, seconds: str, start: str) -> DataFrame:
    """Segments from the part's start on (whole transcript when it has none)."""
    joined = segments.join(parts.select(key, start), key, "left")
    return joined.where(F.col(start).isNull() | (F.col(seconds) >= F.col(start)))


def split_at_first(df: DataFrame, key: str, position: str, flag: Column) -> DataFrame:
    """Add `half` ('before' / 'after') split at the first flagged row, and its position."""
    first = df.where(flag).groupBy(key).agg(F.min(position).alias("split_at"))
    half = F.when(F.col("split_at").isNull() | (F.col(position) < F.col("split_at")), "before").otherwise("after")
    return df.join(first, key, "left").withColumn("half", half)


def first_row(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """One row per key: the values on its first row."""
    return df.groupBy(key).agg(*[F.min_by(v, F.struct(*order)).alias(v) for v in values])


def video_positions(
    segments: DataFrame, videos: DataFrame, key: str, seconds: str, start: str, baseline: DataFrame | None = None,
    clamp: bool = True, wrap_midnight: bool = False, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Each segment with its video part and the second inside that video.

    A video without its own start uses the meeting's baseline.  Videos that start
    together resolve to the lowest part; a segment before all of them to part 1.
    """
    v = videos
    if baseline is not None:
        v = v.join(baseline.select(key, F.col(seconds).alias("_base")), key, "left").withColumn(
            start, F.coalesce(F.col(start), F.col("_base"), F.lit(0))
        ).drop("_base")
    out = asof_backward(segments, v, [key], seconds, start, "part", fallback_first=True, target_rows=target_rows)
    passed = F.col(seconds) - F.col(f"match.{start}")
    if wrap_midnight:
        passed = F.when(passed < 0, passed + DAY).otherwise(passed)
    at = F.coalesce(F.col("match.offset_seconds"), F.lit(0)) + passed
    at = F.greatest(F.lit(0), at) if clamp else at
    return out.withColumn("video_seconds", at).withColumn("video_part", F.col("match.part"))
