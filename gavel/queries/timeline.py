"""Sequence, as-of and clustering queries over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import sampling_window
from ..operators.clusters import anchored_clusters
from ..operators.sequence import Position, Sequence
from ..operators.sweep import points_in_intervals
from ..plans import timeline as tl
from .tables import event_segments, table

ORDER = ["us", "event_id"]
GAP_MINUTES = 360


def gap_detection(spark, d):
    gaps = tl.detect_gaps(event_segments(spark, d), "meeting_id", ORDER, "clock", GAP_MINUTES, seconds=F.col("sec"), wrap=False)
    return gaps.select(
        "meeting_id", "gap_no", "end_timestamp", "resume_timestamp", F.round("gap_minutes", 1).alias("gap_minutes"),
        F.col("event_type").alias("resume_speaker"),
    )


GAPS_SQL = """
gaps AS (
  SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY ts, event_id) AS gap_no FROM (
    SELECT user_id AS meeting_id, event_id, ts, event_type,
           lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
    FROM events) t
  WHERE (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 > 360 * 60)
"""

GAP_DETECTION_SQL = f"""
WITH {GAPS_SQL}
SELECT meeting_id, gap_no, strftime(prev_ts, '%Y-%m-%d %H:%M:%S.%f') AS end_timestamp,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS resume_timestamp,
       round((epoch_us(ts) - epoch_us(prev_ts)) / 1e6 / 60, 1) AS gap_minutes, event_type AS resume_speaker
FROM gaps
"""


def clock_gaps(spark, d):
    """Gaps between wall clocks without a date, one meeting per user and day."""
    e = event_segments(spark, d)
    seg = e.select(
        F.concat_ws("/", F.col("meeting_id").cast("string"), F.to_date("ts").cast("string")).alias("meeting_id"),
        "us", "event_id", F.date_format("ts", "h:mm:ssa").alias("clock"),
    )
    gaps = tl.detect_gaps(seg, "meeting_id", ORDER, "clock", 60)
    return gaps.select("meeting_id", "gap_no", "end_timestamp", "resume_timestamp", "gap_minutes")


CLOCK_GAPS_SQL = """
WITH s AS (
  SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS meeting_id, ts, event_id,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS sec FROM events),
p AS (SELECT *, lag(sec) OVER w AS psec, lag(ts) OVER w AS pts FROM s WINDOW w AS (PARTITION BY meeting_id ORDER BY ts, event_id)),
g AS (SELECT * FROM p WHERE sec - psec > 3600)
SELECT meeting_id, row_number() OVER (PARTITION BY meeting_id ORDER BY ts, event_id) AS gap_no,
       strftime(pts, '%-I:%M:%S%p') AS end_timestamp, strftime(ts, '%-I:%M:%S%p') AS resume_timestamp,
       round_even((sec - psec) / 60.0, 1) AS gap_minutes
FROM g
"""


def _parts(spark, d):
    """Every gap opens a part; part 1 starts with the first segment."""
    seg = event_segments(spark, d)
    gaps = tl.gap_parts(tl.detect_gaps(seg, "meeting_id", ORDER, "clock", GAP_MINUTES, seconds=F.col("sec"), wrap=False))
    later = gaps.select("meeting_id", F.col("sec").alias("start_sec"), "part")
    first = tl.first_row(seg, "meeting_id", ["us", "event_id"], ["sec"]).select(
        "meeting_id", F.col("sec").alias("start_sec"), F.lit(1).alias("part")
    )
    return seg, first.unionByName(later).withColumn("offset_seconds", F.col("part") * 10)


def part_timeline(spark, d):
    """Gaps, then parts, then every segment placed in its part (the flagship)."""
    seg, parts = _parts(spark, d)
    seg = seg.select("meeting_id", "event_id", "sec", "event_type")
    out = tl.video_positions(seg, parts, "meeting_id", "sec", "start_sec")
    return out.select(
        "meeting_id", "event_id", F.col("video_part").cast("bigint").alias("video_part"),
        F.round("video_seconds", 6).alias("video_seconds"),
    )


PART_TIMELINE_SQL = f"""
WITH {GAPS_SQL},
parts AS (
  SELECT meeting_id, ts AS start_ts, gap_no + 1 AS part FROM gaps
  UNION ALL SELECT user_id, min(ts), 1 FROM events GROUP BY user_id)
SELECT e.user_id AS meeting_id, e.event_id, CAST(p.part AS BIGINT) AS video_part,
       round(greatest(0, p.part * 10 + (epoch_us(e.ts) - epoch_us(p.start_ts)) / 1e6), 6) AS video_seconds
FROM events e ASOF JOIN parts p ON e.user_id = p.meeting_id AND e.ts >= p.start_ts
"""


def _videos(seg):
    purchases = seg.where(F.col("event_type") == "purchase").select("meeting_id", "us", "event_id", "sec")
    numbered = Sequence(["meeting_id"], ORDER, ORDER).apply(purchases, part=Position())
    return numbered.select("meeting_id", F.col("sec").alias("start_sec"), "part", F.lit(5).alias("offset_seconds"), F.col("event_id").alias("video_id"))


def asof_video(spark, d):
    """Every segment with the latest video (purchase) before it, else the first one."""
    seg = event_segments(spark, d)
    out = tl.video_positions(seg.select("meeting_id", "event_id", "sec"), _videos(seg), "meeting_id", "sec", "start_sec")
    return out.select(
        "meeting_id", "event_id", F.col("match.video_id").alias("video_id"), "video_part",
        F.round("video_seconds", 6).alias("video_seconds"),
    )


VIDEOS_SQL = """
videos AS (SELECT user_id, event_id AS video_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part
           FROM events WHERE event_type = 'purchase'),
firsts AS (SELECT * FROM videos WHERE part = 1),
hits AS (SELECT e.user_id, e.event_id, e.ts, v.video_id, v.part, v.ts AS vts
         FROM events e
         ASOF LEFT JOIN videos v ON e.user_id = v.user_id AND e.ts >= v.ts)
"""

ASOF_SQL = f"""
WITH {VIDEOS_SQL}
SELECT h.user_id AS meeting_id, h.event_id, coalesce(h.video_id, f.video_id) AS video_id, coalesce(h.part, f.part) AS video_part,
       round(greatest(0, 5 + (epoch_us(h.ts) - epoch_us(coalesce(h.vts, f.ts))) / 1e6), 6) AS video_seconds
FROM hits h LEFT JOIN firsts f USING (user_id)
"""


def asof_unclamped(spark, d):
    """The other as-of: no clamp at zero, 24 h added to a negative distance."""
    seg = event_segments(spark, d)
    out = tl.video_positions(seg.select("meeting_id", "event_id", "sec"), _videos(seg), "meeting_id", "sec", "start_sec", clamp=False, wrap_midnight=True)
    return out.select("meeting_id", "event_id", "video_part", F.round("video_seconds", 6).alias("video_seconds"))


ASOF_UNCLAMPED_SQL = f"""
WITH {VIDEOS_SQL},
x AS (SELECT h.*, coalesce(h.part, f.part) AS vp, (epoch_us(h.ts) - epoch_us(coalesce(h.vts, f.ts))) / 1e6 AS passed
      FROM hits h LEFT JOIN firsts f USING (user_id))
SELECT user_id AS meeting_id, event_id, vp AS video_part,
       round(5 + CASE WHEN passed < 0 THEN passed + 86400 ELSE passed END, 6) AS video_seconds FROM x
"""


def segment_durations(spark, d):
    out = tl.segment_durations(event_segments(spark, d), "meeting_id", ORDER, "sec")
    return out.select("meeting_id", "event_id", F.round("duration", 6).alias("duration"))


DURATIONS_SQL = """
SELECT user_id AS meeting_id, event_id,
       round(coalesce((epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts)) / 1e6, 30), 6) AS duration
FROM events
"""


def speaker_turns(spark, d):
    """Runs of one speaker with their length; the speaker is the event type."""
    turns = tl.speaker_turns(event_segments(spark, d), "meeting_id", ORDER, "event_type")
    return turns.groupBy("meeting_id", "turn_no").agg(
        F.min("event_type").alias("speaker"), F.count(F.lit(1)).alias("segments"), F.min("event_id").alias("first_segment")
    )


TURNS_SQL = """
WITH m AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
t AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS turn_no FROM m)
SELECT user_id AS meeting_id, CAST(turn_no AS BIGINT) AS turn_no, min(event_type) AS speaker, count(*) AS segments, min(event_id) AS first_segment
FROM t GROUP BY ALL
"""


def conversation_turns(spark, d):
    c = table(spark, d, "conversations")
    t = tl.speaker_turns(c, "conv_id", "turn", "role")
    return t.groupBy("conv_id", "turn_no").agg(F.min("role").alias("speaker"), F.count(F.lit(1)).alias("segments"))


CONV_TURNS_SQL = """
WITH m AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS s FROM conversations),
t AS (SELECT *, sum(s) OVER (PARTITION BY conv_id ORDER BY turn) AS turn_no FROM m)
SELECT conv_id, CAST(turn_no AS BIGINT) AS turn_no, min(role) AS speaker, count(*) AS segments FROM t GROUP BY ALL
"""


def search_window(spark, d):
    """Segments up to the first one more than two days after the baseline, at least ten."""
    seg = event_segments(spark, d)
    seg = Sequence(["meeting_id"], ORDER, ORDER).apply(seg, idx=Position())
    out = tl.within_search_window(seg, "meeting_id", "idx", "sec", limit_seconds=2 * 86_400, at_least=10)
    return out.groupBy("meeting_id").agg(F.count(F.lit(1)).alias("kept"), F.max("event_id").alias("last_event"))


SEARCH_WINDOW_SQL = """
WITH n AS (SELECT *, row_number() OVER w AS pos, first_value(ts) OVER w AS base FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
k AS (SELECT *, max(CASE WHEN (epoch_us(ts) - epoch_us(base)) / 1e6 > 172800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS late FROM n)
SELECT user_id AS meeting_id, count(*) AS kept, max(event_id) AS last_event FROM k WHERE late = 0 OR pos <= 10 GROUP BY 1
"""


def first_segments(spark, d):
    seg = event_segments(spark, d)
    return tl.first_row(seg, "meeting_id", ["us", "event_id"], ["clock", "event_type"]).select(
        "meeting_id", F.col("clock").alias("baseline"), F.col("event_type").alias("first_speaker")
    )


FIRST_SQL = """
SELECT user_id AS meeting_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS baseline, arg_min(event_type, (ts, event_id)) AS first_speaker
FROM events GROUP BY 1
"""


def split_at_first(spark, d):
    seg = Sequence(["meeting_id"], ORDER, ORDER).apply(event_segments(spark, d), pos=Position())
    out = tl.split_at_first(seg, "meeting_id", "pos", F.col("event_type") == "purchase")
    return out.groupBy("meeting_id", "half").agg(F.count(F.lit(1)).alias("items"), F.min("split_at").alias("split_at"))


SPLIT_SQL = """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
f AS (SELECT user_id, min(pos) AS split_at FROM n WHERE event_type = 'purchase' GROUP BY 1)
SELECT n.user_id AS meeting_id, CASE WHEN split_at IS NULL OR pos < split_at THEN 'before' ELSE 'after' END AS half,
       count(*) AS items, min(split_at) AS split_at
FROM n LEFT JOIN f USING (user_id) GROUP BY ALL
"""


def part_restriction(spark, d):
    seg = event_segments(spark, d)
    starts = _videos(seg).where(F.col("part") == 2).select("meeting_id", "start_sec")
    kept = tl.restrict_to_part(seg, starts, "meeting_id", "sec", "start_sec")
    return kept.groupBy("meeting_id").agg(F.count(F.lit(1)).alias("segments"), F.min("event_id").alias("baseline_event"))


RESTRICT_SQL = """
WITH v AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part FROM events WHERE event_type = 'purchase')
SELECT e.user_id AS meeting_id, count(*) AS segments, min(e.event_id) AS baseline_event
FROM events e LEFT JOIN v ON e.user_id = v.user_id AND v.part = 2 WHERE v.ts IS NULL OR e.ts >= v.ts GROUP BY 1
"""


def part_starts_saved(spark, d):
    """Gap starts written onto the video rows; a gap without a part is reported."""
    seg = event_segments(spark, d)
    gaps = tl.detect_gaps(seg, "meeting_id", ORDER, "clock", GAP_MINUTES, seconds=F.col("sec"), wrap=False)
    videos = _videos(seg).select("meeting_id", F.col("part").cast("int").alias("part"), F.lit(None).cast("string").alias("transcript_start_time"))
    filled, unmatched = tl.save_part_starts(videos, gaps, "meeting_id")
    return filled.withColumn("outcome", F.lit("video")).unionByName(
        unmatched.select("meeting_id", "part", F.col("resume_timestamp").alias("transcript_start_time"), F.lit("no such part").alias("outcome"))
    )


PART_STARTS_SQL = f"""
WITH {GAPS_SQL},
v AS (SELECT user_id AS meeting_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS part FROM events WHERE event_type = 'purchase'),
s AS (SELECT meeting_id, CAST(gap_no + 1 AS INTEGER) AS part, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS st FROM gaps)
SELECT v.meeting_id, v.part, s.st AS transcript_start_time, 'video' AS outcome FROM v LEFT JOIN s USING (meeting_id, part)
UNION ALL SELECT meeting_id, part, st, 'no such part' FROM s ANTI JOIN v USING (meeting_id, part)
"""


def offsets_saved(spark, d):
    """Offsets rounded half-even onto the matching video rows."""
    seg = event_segments(spark, d)
    videos = _videos(seg).select("meeting_id", "part", F.lit(0).alias("offset_seconds"))
    offsets = seg.where(F.col("event_type") == "error").groupBy("meeting_id").agg(F.max("value").alias("offset")).withColumn("part", F.lit(2).cast("bigint"))
    filled, _ = tl.save_offsets(videos, offsets, ["meeting_id", "part"])
    return filled


OFFSETS_SQL = """
WITH v AS (SELECT user_id AS meeting_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part FROM events WHERE event_type = 'purchase'),
o AS (SELECT user_id AS meeting_id, 2 AS part, CAST(round_even(max(value), 0) AS INTEGER) AS off FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT v.meeting_id, v.part, coalesce(o.off, 0) AS offset_seconds FROM v LEFT JOIN o USING (meeting_id, part)
"""


def sampling_windows(spark, d):
    """Sampling window per meeting and part from first clock and second chapter."""
    seg = event_segments(spark, d)
    first = seg.groupBy("meeting_id").agg(
        F.min_by(F.date_format("ts", "H").cast("int") * 3600 + F.date_format("ts", "m").cast("int") * 60 + F.date_format("ts", "s").cast("int"), F.struct("us", "event_id")).alias("speech"),
        F.max("event_id").alias("m"),
    )
    chapter = F.when(F.col("m") % 3 != 0, F.col("m") % 900)
    w = sampling_window(F.col("m") % 2 + 1, "speech", chapter)
    return first.select("meeting_id", w["start"].alias("start"), w["duration"].alias("duration"))


SAMPLING_SQL = """
WITH f AS (SELECT user_id, arg_min(hour(ts) * 3600 + minute(ts) * 60 + second(ts), (ts, event_id)) AS speech, max(event_id) AS m FROM events GROUP BY 1),
g AS (SELECT *, m % 2 + 1 AS part, CASE WHEN m % 3 <> 0 THEN m % 900 END AS ch,
      CASE WHEN speech >= 28800 AND speech < 43200 THEN 32400 WHEN speech >= 61200 THEN 61200 END AS sched FROM f),
h AS (SELECT *, CASE WHEN sched IS NOT NULL THEN greatest(speech - sched + 300, coalesce(ch, speech - sched + 300)) END AS est FROM g)
SELECT user_id AS meeting_id,
  CAST(CASE WHEN part = 1 THEN CASE WHEN est > 600 THEN est - 300 ELSE 0 END
       ELSE CASE WHEN ch > 120 THEN ch - 120 ELSE 0 END END AS BIGINT) AS start,
  CAST(CASE WHEN part = 1 THEN CASE WHEN est IS NULL THEN 600 WHEN est > 600 THEN 480 ELSE greatest(600, est + 180) END
       ELSE CASE WHEN ch IS NULL THEN 900 WHEN ch > 120 THEN 300 ELSE greatest(600, ch + 120) END END AS BIGINT) AS duration
FROM h
"""


def anchored_offset_clusters(spark, d):
    """Event times of each user in clusters of twelve hours from the cluster's first."""
    seg = event_segments(spark, d).select("meeting_id", F.col("us").cast("double").alias("x"))
    out = anchored_clusters(seg, ["meeting_id"], "x", 12 * 3600 * 1e6)
    return out.groupBy("meeting_id", "anchor").agg(F.count(F.lit(1)).alias("members"), F.max("x").alias("last_x"))


CLUSTERS_SQL = """
WITH RECURSIVE pts AS MATERIALIZED (SELECT DISTINCT user_id, CAST(epoch_us(ts) AS DOUBLE) AS x FROM events),
nxt AS MATERIALIZED (SELECT a.user_id, a.x, b.x AS nx FROM (SELECT *, x + 43200e6 AS lim FROM pts) a ASOF LEFT JOIN pts b ON a.user_id = b.user_id AND a.lim < b.x),
st AS (SELECT user_id, min(x) AS anchor FROM pts GROUP BY 1
       UNION ALL SELECT n.user_id, n.nx FROM st JOIN nxt n ON st.user_id = n.user_id AND st.anchor = n.x WHERE n.nx IS NOT NULL)
SELECT e.user_id AS meeting_id, s.anchor, count(*) AS members, max(CAST(epoch_us(e.ts) AS DOUBLE)) AS last_x
FROM events e ASOF JOIN st s ON e.user_id = s.user_id AND CAST(epoch_us(e.ts) AS DOUBLE) >= s.anchor GROUP BY ALL
"""


def activity_sessions(spark, d):
    """Batch form of the session split by inactivity."""
    e = table(spark, d, "events")
    return (
        e.groupBy(F.session_window("ts", "6 hours").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("segments"), F.min("event_id").alias("first_event"))
        .select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"), "segments", "first_event")
    )


SESSIONS_SQL = """
WITH m AS (SELECT *, CASE WHEN coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > CAST(21600000000 AS BIGINT), true) THEN 1 ELSE 0 END AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
t AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM m)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, count(*) AS segments, min(event_id) AS first_event
FROM t GROUP BY user_id, k
"""

def activity_windows(spark, d):
    """Events of the same user within windows from no width to the whole month, counted per window."""
    e = event_segments(spark, d).select("meeting_id", "event_id", "us", "event_type")
    hours = F.when(F.col("event_id") % 50 == 0, 24 * 40).otherwise(F.col("event_id") % 97)
    windows = e.where("event_type = 'signup'").select("meeting_id", F.col("event_id").alias("window_id"), "us", (F.col("us") + hours * 3_600_000_000).alias("until"))
    found = points_in_intervals(e, windows, ["meeting_id"], "event_id", "us", "window_id", "us", "until")
    return found.groupBy("window_id").agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_id"))


ACTIVITY_WINDOWS_SQL = """
SELECT w.event_id AS window_id, count(*) AS events, max(e.event_id) AS last_id
FROM events w JOIN events e ON e.user_id = w.user_id AND epoch_us(e.ts) >= epoch_us(w.ts)
 AND epoch_us(e.ts) <= epoch_us(w.ts) + CASE WHEN w.event_id % 50 = 0 THEN 960 ELSE w.event_id % 97 END * CAST(3600000000 AS BIGINT)
WHERE w.event_type = 'signup' GROUP BY 1
"""


QUERIES = {
    "activity_windows": (activity_windows, ACTIVITY_WINDOWS_SQL),
    "gap_detection": (gap_detection, GAP_DETECTION_SQL),
    "clock_gaps": (clock_gaps, CLOCK_GAPS_SQL),
    "part_timeline": (part_timeline, PART_TIMELINE_SQL),
    "asof_video": (asof_video, ASOF_SQL),
    "asof_unclamped": (asof_unclamped, ASOF_UNCLAMPED_SQL),
    "segment_durations": (segment_durations, DURATIONS_SQL),
    "speaker_turns": (speaker_turns, TURNS_SQL),
    "conversation_turns": (conversation_turns, CONV_TURNS_SQL),
    "search_window": (search_window, SEARCH_WINDOW_SQL),
    "first_segments": (first_segments, FIRST_SQL),
    "split_at_first": (split_at_first, SPLIT_SQL),
    "part_restriction": (part_restriction, RESTRICT_SQL),
    "part_starts_saved": (part_starts_saved, PART_STARTS_SQL),
    "offsets_saved": (offsets_saved, OFFSETS_SQL),
    "sampling_windows": (sampling_windows, SAMPLING_SQL),
    "anchored_offset_clusters": (anchored_offset_clusters, CLUSTERS_SQL),
    "activity_sessions": (activity_sessions, SESSIONS_SQL),
}
