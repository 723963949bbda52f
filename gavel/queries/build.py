"""The warehouse build from end to end: tables nested into JSON files, scanned, and built.

Customers are meetings and their orders agenda items, suppliers are transcripts and lines
their segments.  Files go to the shared scratch folder, with a broken and a backup file among them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import warehouse
from ..session import stored
from ..sources import files
from .streams import _scratch
from .tables import table

PREFIX = {0: "CRA-", 1: "REZ-", 2: "PS"}
TYPE = {0: "cra", 1: "evening", 2: "regular"}
#: Meetings, or video mappings, of one file at most: the files grow in number, not in size.
BUNDLE = 64


def _pick(key: str, values: dict):
    out = F.lit(values[2])
    for k in (0, 1):
        out = F.when(F.col(key) % 3 == k, values[k]).otherwise(out)
    return out


def _day(shift):
    return F.date_format(F.date_add(F.lit("1998-01-01").cast("date"), shift.cast("int")), "yyyy-MM-dd")


def _file(key: str, kinds: int):
    """The number of the file of a key: at most BUNDLE keys share one, and its rest by `kinds` is that of its keys."""
    return F.col(key) % kinds + kinds * F.floor(F.col(key) / (kinds * BUNDLE)).cast("bigint")


def _folder(spark, d) -> str:
    """Meeting, transcript and video files of the tables."""
    out = _scratch(spark)
    o = table(spark, d, "orders")
    doc = F.struct(F.lit("").alias("title"), F.concat(F.lit("Sheet "), "o_orderkey").alias("originalText"), F.concat(F.lit("/d/"), "o_orderkey").alias("url"))
    item = F.struct(
        F.col("o_orderkey").alias("key"),
        F.concat(_pick("o_custkey", PREFIX), F.lit("25-"), "o_orderkey").alias("fileNumber"),
        F.concat(F.lit("Order "), "o_orderkey").alias("title"),
        F.array(doc).alias("supportingDocuments"),
        F.struct((F.col("o_orderkey") % 100).cast("double").alias("expenditures")).alias("financialTotals"),
    )
    day = _day(F.col("o_custkey") % 300)
    m = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("agendaItems"))
    version = lambda v: F.to_json(F.struct(F.col("o_custkey").cast("string").alias("meetingId"), day.alias("formattedDate"), F.lit(v).alias("agendaType"), F.when(F.lit(v) == "FINAL", F.col("agendaItems")).alias("agendaItems")))
    rows = m.select(_file("o_custkey", 16).alias("part"), version("FINAL").alias("j"), version("DRAFT").alias("draft"))
    bundle = lambda column: F.concat(F.lit("["), F.array_join(F.collect_list(column), ","), F.lit("]"))
    named = lambda tail: F.concat(F.lit("meeting_"), "part", F.lit(tail))
    final = rows.groupBy("part").agg(bundle("j").alias("content")).select(named("_2025-02-01.json").alias("name"), "content")
    drafts = rows.groupBy("part").agg(bundle("draft").alias("content")).select(named("_2025-01-01.json").alias("name"), "content")
    old = drafts.select(F.replace("name", F.lit("_2025-01-01"), F.lit("_2025-03-01_old")).alias("name"), "content")
    broken = rows.select((F.col("part") % 16).alias("part")).distinct().select(named("_2025-04-01.json").alias("name"), F.lit("{ broken").alias("content"))

    lines = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s"), "l_linenumber").agg(F.min("l_partkey").alias("p"))
    segment = F.struct(F.col("l_linenumber").alias("n"), F.concat(F.lit("9:0"), "l_linenumber", F.lit(":00AM")).alias("timestamp"), F.lit("CHAIR").alias("speaker"), F.concat(F.lit("PART "), "p").alias("text"))
    t = lines.groupBy("s").agg(F.array_sort(F.collect_list(segment)).alias("segments")).withColumn("day", _day(F.col("s") * 7 % 320))
    body = lambda field: F.to_json(F.struct(F.col("s").cast("string").alias("meeting_id"), F.col("segments").alias(field)))
    processed = t.where("s % 4 <> 1").select(F.concat(F.lit("processed_transcript_"), "s", F.lit("_"), "day", F.lit(".json")).alias("name"), F.when(F.col("s") % 2 == 0, body("segments")).otherwise(body("transcript")).alias("content"))
    raw = t.where("s % 4 < 2").select(F.concat(F.lit("transcript_"), "s", F.lit("_"), "day", F.lit(".json")).alias("name"), body("segments").alias("content"))
    test = t.where("s % 50 = 0").select(F.concat(F.lit("transcript_--transcript-id_"), "s", F.lit(".json")).alias("name"), body("segments").alias("content"))
    chapter = F.struct(F.lit("Start").alias("title"), F.lit("0:10").alias("timestamp"), (F.col("s") % 60).cast("int").alias("seconds"))
    video = F.struct(F.concat(F.lit("v"), "s").alias("video_id"), F.lit(1).alias("part"), F.lit("PT1H2S").alias("duration"), (F.col("s") % 10 + 0.5).alias("offset_seconds"), F.array(chapter).alias("chapters"))
    maps = t.where("s % 2 = 0").select(F.to_json(F.struct(F.col("s").alias("meeting_id"), F.col("day").alias("meeting_date"), F.array(video).alias("videos"))).alias("j"), _file("s", 4).alias("part"))
    maps = maps.groupBy("part").agg(bundle("j").alias("content")).select(F.concat(F.lit("video_mapping_"), "part", F.lit(".json")).alias("name"), "content")
    every = [final, drafts, old, broken, processed, raw, test, maps]
    contents = every[0]
    for e in every[1:]:
        contents = contents.unionByName(e)
    files.write_files(contents, out)
    return out


def _scanned(spark, d):
    folder = _folder(spark, d)
    good, bad = files.split_corrupt(stored(files.meetings(spark, folder, strict_name=True), "meetings"))
    return good, bad, _transcripts(spark, folder), files.video_maps(spark, folder), folder


def _transcripts(spark, folder):
    found = files.preferred_transcripts(files.processed_transcripts(spark, folder), files.raw_transcripts(spark, folder))
    return found.drop("_corrupt_record")


def _built(spark, d, year=None):
    good, _, transcripts, maps, _ = _scanned(spark, d)
    key = F.col("transcript_id").cast("bigint")
    overrides = transcripts.select("transcript_id", key.alias("k")).select("transcript_id", _pick("k", TYPE).alias("meeting_type"))
    return warehouse.build(good, transcripts, maps, overrides, year)


BUILT_SQL = """
c AS (SELECT o_custkey AS id, DATE '1998-01-01' + CAST(o_custkey % 300 AS INTEGER) AS date, count(*) AS item_count,
        CASE o_custkey % 3 WHEN 0 THEN 'cra' WHEN 1 THEN 'evening' ELSE 'regular' END AS meeting_type FROM orders GROUP BY o_custkey),
kept AS (SELECT date, meeting_type, arg_max(id, (item_count, -id)) AS id, max(item_count) AS item_count FROM c GROUP BY 1, 2),
s AS (SELECT l_suppkey AS s, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
t AS (SELECT DISTINCT s AS tid, DATE '1998-01-01' + CAST(s * 7 % 320 AS INTEGER) AS date,
        CASE s % 3 WHEN 0 THEN 'cra' WHEN 1 THEN 'evening' ELSE 'regular' END AS meeting_type FROM s),
g AS (SELECT date, meeting_type, min(tid) AS first_id, max(tid) AS last_id FROM t GROUP BY 1, 2),
own AS (SELECT g.*, coalesce(kept.id, -first_id - 1) AS id, kept.id IS NULL AS stub FROM g LEFT JOIN kept USING (date, meeting_type))
"""


def scanned_meetings(spark, d):
    """Good and broken meeting files by a strict name; backups stay out."""
    good, bad, _, _, folder = _scanned(spark, d)
    one = files.meeting_by_id(files.meetings(spark, folder), "3")
    kinds = [
        good.where(F.col("agendaType") == "FINAL").select(F.lit("final").alias("kind")),
        files.meetings_on(good, "2025-01-01").select(F.lit("on date").alias("kind")),
        bad.select(F.lit("broken").alias("kind")),
        one.select(F.lit("first of id").alias("kind")),
    ]
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


SCANNED_SQL = """
WITH c AS (SELECT DISTINCT o_custkey AS id FROM orders)
SELECT 'final' AS kind, count(*) AS n FROM c UNION ALL SELECT 'on date', count(*) FROM c
UNION ALL SELECT 'broken', count(DISTINCT id % 16) FROM c UNION ALL SELECT 'first of id', 1
"""


def scanned_transcripts(spark, d):
    """Processed before raw, both spellings of the segments, test files left out."""
    t = _transcripts(spark, _folder(spark, d))
    return t.select(F.col("transcript_id").cast("bigint").alias("transcript_id"), "date", F.size("segments").cast("bigint").alias("segments"), F.element_at(F.split("file_name", "_"), 1).alias("source"))


TRANSCRIPT_SCAN_SQL = """
SELECT l_suppkey AS transcript_id, DATE '1998-01-01' + CAST(l_suppkey * 7 % 320 AS INTEGER) AS date, count(DISTINCT l_linenumber) AS segments,
  CASE WHEN l_suppkey % 4 <> 1 THEN 'processed' ELSE 'transcript' END AS source FROM lineitem GROUP BY l_suppkey
"""


def built_meetings(spark, d):
    m = _built(spark, d)["meetings"]
    return m.select("id", "date", "meeting_type", F.col("item_count").cast("bigint").alias("item_count"), "transcript_source_id", F.col("is_stub").cast("int").alias("stub"))


def built_year(spark, d):
    """One year only, agendas and transcripts alike."""
    m = _built(spark, d, 1998)["meetings"]
    return m.groupBy("meeting_type").agg(F.count(F.lit(1)).alias("meetings"), F.max("date").alias("last"))


def built_items(spark, d):
    i = _built(spark, d)["agenda_items"]
    return i.select("meeting_id", F.col("item_pos").cast("bigint").alias("item_pos"), "file_number", "title", F.col("fiscal_expenditures").cast("double").alias("spent"))


def built_documents(spark, d):
    x = _built(spark, d)["documents"]
    return x.select("meeting_id", F.col("item_pos").cast("bigint").alias("item_pos"), F.col("doc_pos").cast("bigint").alias("doc_pos"), "title", "source_url")


def built_segments(spark, d):
    x = _built(spark, d)["transcript_segments"]
    return x.select("meeting_id", F.col("segment_index").cast("bigint").alias("segment_index"), "speaker", "text", F.col("sec_of_day").cast("bigint").alias("sec"))


def built_videos(spark, d):
    """Videos with their chapter."""
    b = _built(spark, d)
    chapters = b["video_chapters"].select("video_id", F.col("seconds").cast("bigint").alias("chapter_second"))
    v = b["videos"].join(chapters, "video_id")
    return v.select("meeting_id", "video_id", F.col("part").cast("bigint").alias("part"), F.col("duration_sec").cast("bigint").alias("duration_sec"), F.col("offset_seconds").cast("bigint").alias("offset_seconds"), "chapter_second")


def built_orphans(spark, d):
    """Child rows without a meeting, per table: none."""
    return warehouse.orphans(_built(spark, d)).select("table", "orphans")


QUERIES = {
    "scanned_meetings": (scanned_meetings, SCANNED_SQL),
    "scanned_transcripts": (scanned_transcripts, TRANSCRIPT_SCAN_SQL),
    "built_meetings": (
        built_meetings,
        f"""WITH {BUILT_SQL} SELECT kept.id, kept.date, kept.meeting_type, item_count, CAST(last_id AS VARCHAR) AS transcript_source_id, 0 AS stub FROM kept LEFT JOIN own USING (id)
            UNION ALL SELECT id, date, meeting_type, 0, CAST(last_id AS VARCHAR), 1 FROM own WHERE stub""",
    ),
    "built_year": (
        built_year,
        f"""WITH {BUILT_SQL}, m AS (SELECT id, date, meeting_type FROM kept UNION SELECT id, date, meeting_type FROM own WHERE stub)
            SELECT meeting_type, count(*) AS meetings, max(date) AS last FROM m WHERE year(date) = 1998 GROUP BY 1""",
    ),
    "built_items": (
        built_items,
        f"""WITH {BUILT_SQL} SELECT o_custkey AS meeting_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS item_pos,
              CASE o_custkey % 3 WHEN 0 THEN 'CRA-' WHEN 1 THEN 'REZ-' ELSE 'PS' END || '25-' || o_orderkey AS file_number, 'Order ' || o_orderkey AS title,
              CAST(o_orderkey % 100 AS DOUBLE) AS spent FROM orders WHERE o_custkey IN (SELECT id FROM kept)""",
    ),
    "built_documents": (
        built_documents,
        f"""WITH {BUILT_SQL} SELECT o_custkey AS meeting_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS item_pos, CAST(0 AS BIGINT) AS doc_pos,
              'Sheet ' || o_orderkey AS title, '/d/' || o_orderkey AS source_url FROM orders WHERE o_custkey IN (SELECT id FROM kept)""",
    ),
    "built_segments": (
        built_segments,
        f"""WITH {BUILT_SQL} SELECT own.id AS meeting_id, row_number() OVER (PARTITION BY s ORDER BY n) - 1 AS segment_index, 'CHAIR' AS speaker, 'PART ' || p AS text,
              CAST(32400 + 60 * n AS BIGINT) AS sec FROM own JOIN s ON s.s = own.last_id""",
    ),
    "built_videos": (
        built_videos,
        f"""WITH {BUILT_SQL} SELECT id AS meeting_id, 'v' || last_id AS video_id, CAST(1 AS BIGINT) AS part, CAST(3602 AS BIGINT) AS duration_sec,
              CAST(round_even(last_id % 10 + 0.5, 0) AS BIGINT) AS offset_seconds, last_id % 60 AS chapter_second FROM own WHERE last_id % 2 = 0""",
    ),
    "built_orphans": (built_orphans, "SELECT unnest(['agenda_items', 'documents', 'transcript_segments', 'videos', 'video_chapters']) AS \"table\", CAST(0 AS BIGINT) AS orphans"),
}
