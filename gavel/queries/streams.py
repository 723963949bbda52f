"""Incremental queries: the given tables as a stream of files, results compared to batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import warehouse
from ..plans.partials import Partials
from ..session import checkpoint_dir, removed_at_exit, stored
from ..streaming import incremental, stateful
from .tables import meetings, table


def _scratch(spark) -> str:
    return removed_at_exit(spark, f"{checkpoint_dir(spark)}/gavel-{uuid.uuid4().hex}")


def _stream(spark, d, name):
    schema = spark.read.parquet(f"{d}/{name}.parquet").schema
    return incremental.new_files(spark, d, schema, "parquet", pathGlobFilter=f"{name}.parquet")


def incremental_pickup(spark, d):
    """Many new files, one per batch, written by partition; the second run finds nothing and changes nothing."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    out = _scratch(spark)
    events = table(spark, d, "events").select("event_type", "event_id", "user_id")
    events.repartition(5).write.parquet(f"{out}/in")
    for _ in range(2):
        stream = incremental.new_files(spark, f"{out}/in", events.schema, "parquet", files_per_batch=1)
        write = incremental.append_partitions(f"{out}/table", "event_type", lambda b: b)
        incremental.run_available(stream, f"{out}/state", write)
    stored = spark.read.parquet(f"{out}/table")
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum"))


def incremental_supersede(spark, d):
    """The best version per key survives, whichever batch it came in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    out = _scratch(spark)
    shape = lambda b: b.select(F.to_date("o_orderdate").alias("date"), "o_orderpriority", "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    keep = incremental.supersede(f"{out}/table", ["date", "o_orderpriority"], [F.col("o_totalprice"), -F.col("o_orderkey")], "year")
    for run in range(2):
        # the second run replays the same files under a new checkpoint: nothing may change
        incremental.run_available(_stream(spark, d, "orders"), f"{out}/state{run}", lambda b, e: keep(shape(b), e))
    return spark.read.parquet(f"{out}/table").select("date", "o_orderpriority", "o_orderkey", "o_totalprice")


def streamed_sessions(spark, d):
    """Sessions split by inactivity, from the stream."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    out = _scratch(spark)
    events = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sessions = incremental.activity_sessions(events, "user_id", "ts", "6 hours")
    query = (
        sessions.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{out}/state")
        .foreachBatch(lambda b, e: b.write.mode("overwrite").parquet(f"{out}/table")).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/table").select(
        "user_id", F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"), F.col("rows").alias("segments")
    )


#: Files that the events arrive in, and how long a row may be late: two files.
SLICES = 4
#: Rows whose users share a state, about: states grow in number with the events, not in size.
STATE_ROWS = 5_000


def _arriving(spark, d, out, shape):
    """Run `shape` over events that arrive in files, out of order across them, and with a restart from the checkpoint
    after half of them.  A last file with one row far ahead lets the watermark pass what is open."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    low, high, n = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts")), F.count(F.lit(1))).first()
    width = (high - low) // SLICES + 1
    slot = F.floor((F.unix_micros("ts") - low) / width).cast("int") + (F.col("event_id") % 3 == 0).cast("int")  # a third comes one file later
    sliced = stored(events.withColumn("slot", F.least(slot, F.lit(SLICES - 1))), "arriving")
    seconds = 2 * width // 1_000_000 + 1
    files = max(2, sliced.rdd.getNumPartitions())  # of a batch: more rows arrive in more files, not in longer ones

    def arrive(rows):
        rows.select(events.columns).coalesce(files).write.mode("append").parquet(f"{out}/in")

    def run():
        stream = incremental.new_files(spark, f"{out}/in", events.schema, "parquet", files_per_batch=files)
        with stateful.keyed_state(spark):
            found = shape(stream, f"{seconds} seconds", -(-n // STATE_ROWS))
            query = (
                found.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                .option("checkpointLocation", f"{out}/state").option("path", f"{out}/table").start()
            )
            query.awaitTermination()

    for k in range(SLICES):
        arrive(sliced.where(F.col("slot") == k))
        if k == SLICES // 2:
            run()
    ahead = F.timestamp_micros(F.lit(high + 10 * (seconds + 86_400 * 2) * 1_000_000))
    arrive(events.limit(1).select(F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("event_id"), ahead.alias("ts"), "event_type"))
    run()
    return spark.read.parquet(f"{out}/table").where("user_id >= 0")


def streamed_gaps(spark, d):
    """Pauses of more than six hours per user, from state that outlives a restart."""
    found = _arriving(spark, d, _scratch(spark), lambda s, late, buckets: stateful.streamed_gaps(s, "user_id", "ts", "event_id", "event_type", 360, late, buckets=buckets))
    return found.select("user_id", "gap_no", "end_us", "resume_us", F.col("label").alias("resume_speaker"))


def streamed_turns(spark, d):
    """Runs of one event type per user without a pause of more than six hours."""
    return _arriving(spark, d, _scratch(spark), lambda s, late, buckets: stateful.streamed_turns(s, "user_id", "ts", "event_id", "event_type", 360, late, buckets=buckets))


STREAMED_GAPS_SQL = """
WITH p AS (SELECT *, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap_no, before AS end_us, epoch_us(ts) AS resume_us, event_type AS resume_speaker
FROM p WHERE epoch_us(ts) - before > CAST(21600000000 AS BIGINT)
"""
STREAMED_TURNS_SQL = """
WITH m AS (
  SELECT *, CASE WHEN coalesce(event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND epoch_us(ts) - epoch_us(lag(ts) OVER w) <= CAST(21600000000 AS BIGINT), false)
                 THEN 0 ELSE 1 END AS s
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
t AS (SELECT *, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS turn_no FROM m)
SELECT user_id, turn_no, any_value(event_type) AS label, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us, count(*) AS segments
FROM t GROUP BY user_id, turn_no
"""


def stored_warehouse(spark, d):
    """Tables written by year and read back for one year."""
    out = _scratch(spark)
    m = meetings(spark, d).withColumn("year", F.year("date"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("meeting_id"), F.col("l_linenumber").alias("item_number"), "l_partkey")
    items = li.join(m.select(F.col("id").alias("meeting_id"), "year"), "meeting_id")
    warehouse.write({"meetings": m, "agenda_items": items}, out)
    stored = spark.read.parquet(f"{out}/agenda_items").where(F.col("year") == 1997)
    return stored.groupBy("meeting_id").agg(F.count(F.lit(1)).alias("items"), F.sum("l_partkey").alias("part_sum"))


def write_counts(spark, d):
    """Rows and sums of two tables, counted while they are written."""
    m = meetings(spark, d).withColumn("year", F.year("date"))
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("year"))
    wanted = {
        "meetings": {"without_items": F.count(F.when(F.col("item_count") == 0, 1)), "finished": F.count(F.when(F.col("o_orderstatus") == "F", 1))},
        "agenda_items": {"first_items": F.count(F.when(F.col("l_linenumber") == 1, 1)), "part_sum": F.sum("l_partkey")},
    }
    return warehouse.write_counted({"meetings": m, "agenda_items": items}, _scratch(spark), wanted)


def stored_totals(spark, d):
    """Rows, values and users per event type from weekly partials, one week delivered twice; users within 5 % of the exact number."""
    e = table(spark, d, "events").withColumn("week", F.weekofyear("ts")).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    totals = Partials(spark, _scratch(spark), ["event_type"], {"cents": "cents"}, {"users": "user_id"})
    weeks = [r["week"] for r in e.select("week").distinct().collect()]  # at most 53
    for week in [weeks[0], *weeks]:
        totals.add(e.where(F.col("week") == week), str(week))
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    close = F.abs(F.col("users") - F.col("exact")) <= 0.05 * F.col("exact")
    return totals.read().join(exact, "event_type").select("event_type", "rows", "cents", close.alias("users_close"))


QUERIES = {
    "stored_totals": (
        stored_totals,
        """SELECT event_type, count(*) AS "rows", CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, true AS users_close FROM events GROUP BY 1""",
    ),
    "write_counts": (
        write_counts,
        """WITH m AS (SELECT count(*) AS "rows", count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS without_items, count(*) FILTER (o_orderstatus = 'F') AS finished FROM orders),
           i AS (SELECT count(*) AS "rows", count(*) FILTER (l_linenumber = 1) AS first_items, CAST(sum(l_partkey) AS BIGINT) AS part_sum FROM lineitem)
           SELECT 'meetings' AS "table", metric, value FROM (UNPIVOT m ON COLUMNS(*) INTO NAME metric VALUE value)
           UNION ALL SELECT 'agenda_items', metric, value FROM (UNPIVOT i ON COLUMNS(*) INTO NAME metric VALUE value)""",
    ),
    "incremental_pickup": (incremental_pickup, "SELECT event_type, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1"),
    "incremental_supersede": (
        incremental_supersede,
        """SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey, max(o_totalprice) AS o_totalprice
           FROM orders GROUP BY 1, 2""",
    ),
    "streamed_sessions": (
        streamed_sessions,
        """WITH m AS (SELECT *, CASE WHEN coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > CAST(21600000000 AS BIGINT), true) THEN 1 ELSE 0 END AS s
             FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
           t AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM m)
           SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, count(*) AS segments FROM t GROUP BY user_id, k""",
    ),
    "streamed_gaps": (streamed_gaps, STREAMED_GAPS_SQL),
    "streamed_turns": (streamed_turns, STREAMED_TURNS_SQL),
    "stored_warehouse": (
        stored_warehouse,
        """SELECT l_orderkey AS meeting_id, count(*) AS items, CAST(sum(l_partkey) AS BIGINT) AS part_sum FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           WHERE year(o_orderdate) = 1997 GROUP BY 1""",
    ),
}
