"""Scans that files made of the given tables go through: chosen record files, name lists, file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import first_titled
from ..sources import datasource, files
from .build import _folder
from .streams import _scratch
from .tables import table


def selected_records(spark, d):
    """Records of the final meeting files alone, and the broken files of another day; the rest is never opened."""
    folder = _folder(spark, d)
    load = lambda: datasource.record_files(spark, folder, "meeting")  # noqa: E731  (one load for each filter)
    final = load().where("date = DATE '2025-02-01'").groupBy("file_name").agg(F.count("value").alias("records"), F.count("corrupt").alias("broken"))
    broken = datasource.quarantine(load().where("date = DATE '2025-04-01' AND year = 2025"))
    broken = broken.where(F.col("corrupt") == "{ broken").select("file_name", F.lit(0).cast("long").alias("records"), F.lit(1).cast("long").alias("broken"))
    return final.unionByName(broken)


PARTS = "SELECT DISTINCT o_custkey AS id, o_custkey % 16 + 16 * CAST(floor(o_custkey / 1024) AS BIGINT) AS part FROM orders"
SELECTED_SQL = f"""
WITH c AS ({PARTS})
SELECT 'meeting_' || part || '_2025-02-01.json' AS file_name, count(*) AS records, CAST(0 AS BIGINT) AS broken FROM c GROUP BY part
UNION ALL SELECT DISTINCT 'meeting_' || id % 16 || '_2025-04-01.json', 0, CAST(1 AS BIGINT) FROM c
"""


def meeting_metadata(spark, d):
    """What the names of the meeting files and their items say, per file."""
    good, _ = files.split_corrupt(files.meetings(spark, _folder(spark, d)))
    rows = files.meeting_metadata(good).groupBy("filename", "meetingId", "date")
    return rows.agg(F.count(F.lit(1)).alias("meetings"), F.sum("agendaItemCount").cast("bigint").alias("items"))


METADATA_SQL = f"""
WITH c AS ({PARTS}), n AS (SELECT o_custkey AS id, count(*) AS items FROM orders GROUP BY 1),
f AS (SELECT part, count(*) AS meetings, CAST(sum(items) AS BIGINT) AS items FROM c JOIN n USING (id) GROUP BY part)
SELECT 'meeting_' || part || '_2025-02-01.json' AS filename, CAST(part AS VARCHAR) AS "meetingId", '2025-02-01' AS date, meetings, items FROM f
UNION ALL SELECT 'meeting_' || part || '_2025-01-01.json', CAST(part AS VARCHAR), '2025-01-01', meetings, 0 FROM f
"""


def country_scan(spark, d):
    """Both names of every row of CSV files made of the suppliers, distinct; blank official names fall back."""
    out = _scratch(spark)
    s = table(spark, d, "supplier")
    official = F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.concat(F.lit("Republic of "), "s_name"))
    shown = F.when(F.col("s_suppkey") % 5 == 0, " ").otherwise(F.concat(F.lit("Land "), (F.col("s_suppkey") % 50).cast("string")))
    s.select(official.alias("official_name_en"), F.col("s_nationkey").alias("Dial"), shown.alias("CLDR display name")).write.option("header", True).csv(f"{out}/countries")
    return files.country_names(spark, f"{out}/countries")


COUNTRY_SQL = """
WITH s AS (SELECT CASE WHEN s_suppkey % 3 > 0 THEN 'Republic of ' || s_name END AS official, CASE WHEN s_suppkey % 5 > 0 THEN 'Land ' || s_suppkey % 50 END AS shown FROM supplier)
SELECT DISTINCT name FROM (SELECT unnest([coalesce(official, shown), shown]) AS name FROM s) WHERE name IS NOT NULL
"""


def first_documents(spark, d):
    """The first summary sheet and the first packet among the documents of every order, in reading order."""
    title = F.concat(F.element_at(F.array(*[F.lit(t) for t in ("Summary Sheet ", "Map ", "Agenda PACKET ", "summary sheet copy ")]), (F.col("l_partkey") % 4 + 1).cast("int")), F.col("l_partkey").cast("string"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    docs = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", title.alias("title")))), lambda x: F.struct(x["title"].alias("title"), x["l_linenumber"].alias("n")))
    rows = lines.groupBy("l_orderkey").agg(docs.alias("docs"))
    sheet, packet = first_titled("docs", "summary sheet"), first_titled("docs", "packet")
    return rows.select("l_orderkey", sheet["title"].alias("sheet"), packet["title"].alias("packet"), packet["n"].alias("packet_line"))


FIRST_DOCUMENTS_SQL = """
WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
t AS (SELECT *, CASE p % 4 WHEN 0 THEN 'Summary Sheet ' WHEN 1 THEN 'Map ' WHEN 2 THEN 'Agenda PACKET ' ELSE 'summary sheet copy ' END || p AS title FROM l)
SELECT l_orderkey, arg_min(title, l_linenumber) FILTER (p % 4 IN (0, 3)) AS sheet, arg_min(title, l_linenumber) FILTER (p % 4 = 2) AS packet,
  min(l_linenumber) FILTER (p % 4 = 2) AS packet_line FROM t GROUP BY 1
"""

def mixed_shapes(spark, d):
    """Transcripts as bare lists, under either name, or broken, and sums as an object or a list: one scan for all."""
    out = _scratch(spark)
    lines = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s"), "l_linenumber").agg(F.min("l_partkey").alias("p"))
    segment = F.struct(F.col("l_linenumber").alias("n"), F.lit("9:00:00AM").alias("timestamp"), F.concat(F.lit("PART "), "p").alias("text"))
    t = lines.groupBy("s").agg(F.array_sort(F.collect_list(segment)).alias("x"), F.sum("p").alias("total"))
    amounts = F.to_json(F.transform("x", lambda x: F.struct(F.substring(x["text"], 6, 20).cast("long").alias("value"))))
    kind = F.col("s") % 6
    content = (
        F.when(kind == 0, F.to_json("x")).when(kind == 1, F.to_json(F.struct(F.col("x").alias("segments")))).when(kind == 2, F.to_json(F.struct(F.col("x").alias("transcript"))))
        .when(kind == 3, F.to_json(F.struct(F.col("total").alias("net")))).when(kind == 4, amounts).otherwise(F.lit('{"segments": ['))
    )
    files.write_files(t.select(F.concat(F.lit("record_"), "s", F.lit(".json")).alias("name"), content.alias("content")), out)
    rows = files.mixed_records(spark, out)
    said = files.variant_segments(F.col("record"))
    summed = F.regexp_extract("file_name", r"(\d+)", 1).cast("long") % 6 >= 3
    return rows.select(
        "file_name", F.regexp_extract("shape", "^[A-Z]+", 0).alias("shape"), F.when(~summed, F.size(said).cast("long")).alias("segments"),
        F.when(~summed, F.element_at(F.transform(said, lambda x: x["text"]), -1)).alias("last_text"),
        F.when(summed, files.variant_total(F.col("record"))).alias("total"), "corrupt",
    )


MIXED_SQL = """
WITH l AS (SELECT l_suppkey AS s, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
t AS (SELECT s, count(*) AS segments, arg_max('PART ' || p, n) AS last_text, CAST(sum(p) AS DOUBLE) AS total FROM l GROUP BY s)
SELECT 'record_' || s || '.json' AS file_name, CASE s % 6 WHEN 0 THEN 'ARRAY' WHEN 4 THEN 'ARRAY' WHEN 5 THEN NULL ELSE 'OBJECT' END AS shape,
  CASE WHEN s % 6 < 3 THEN segments END AS segments, CASE WHEN s % 6 < 3 THEN last_text END AS last_text,
  CASE WHEN s % 6 IN (3, 4) THEN total END AS total, CASE WHEN s % 6 = 5 THEN '{"segments": [' END AS corrupt FROM t
"""

QUERIES = {
    "mixed_shapes": (mixed_shapes, MIXED_SQL),
    "selected_records": (selected_records, SELECTED_SQL),
    "meeting_metadata": (meeting_metadata, METADATA_SQL),
    "country_scan": (country_scan, COUNTRY_SQL),
    "first_documents": (first_documents, FIRST_DOCUMENTS_SQL),
}
