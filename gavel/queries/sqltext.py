"""The registered SQL functions and table functions, used from SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql
from .tables import page_table, table


def _view(rows, name: str) -> None:
    rows.createOrReplaceTempView(name)


def sql_filters(spark, d):
    """The eight display functions on orders."""
    sql.register(spark)
    _view(table(spark, d, "orders"), "display_orders")
    return spark.sql("""
        SELECT o_orderkey, meeting_type_label(kind) AS label, readable_date(day) AS readable, short_date(day) AS short,
               thumbnail_url(video) AS thumb, clean_title(concat('File No. PS25-', o_custkey, ' \\n Item ', o_orderkey, ' ')) AS title,
               has_content(video) AS filled, watch_url(video, CAST(o_custkey AS BIGINT)) AS watch, seek.seconds AS seek_seconds, seek.part AS seek_part
        FROM (SELECT *, seek_in_videos(CAST(o_custkey AS BIGINT), array(
                  named_struct('part', 1, 'start_sec', 100L, 'offset_seconds', 2.5D),
                  named_struct('part', 2, 'start_sec', 700L, 'offset_seconds', 0D))) AS seek
              FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'cra' WHEN 1 THEN 'evening' ELSE 'other' END AS kind, CAST(o_orderdate AS DATE) AS day,
                           CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('v', o_orderkey) END AS video FROM display_orders))""")


FILTERS_SQL = """
WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'v' || o_orderkey END AS video FROM orders)
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'CRA' WHEN 1 THEN 'Evening Session' ELSE 'other' END AS label,
  strftime(o_orderdate, '%A, %B %-d, %Y') AS readable, strftime(o_orderdate, '%b %-d, %Y') AS short,
  CASE WHEN o_orderkey % 4 > 0 THEN 'https://img.youtube.com/vi/' || video || '/mqdefault.jpg' END AS thumb, 'Item ' || o_orderkey AS title,
  o_orderkey % 4 > 0 AS filled, 'https://youtu.be/' || video || '?t=' || o_custkey AS watch,
  CASE WHEN o_custkey >= 700 THEN CAST(o_custkey - 700 AS DOUBLE) ELSE greatest(0.0, 2.5 + o_custkey - 100)::DOUBLE END AS seek_seconds,
  CASE WHEN o_custkey >= 700 THEN 2 ELSE 1 END AS seek_part FROM o
"""


def sql_chapters(spark, d):
    """Chapter lines of made descriptions, one row each."""
    sql.register(spark)
    _view(table(spark, d, "events"), "described_events")
    return spark.sql("""
        SELECT event_id, c.chapter_no, c.title, c.clock, c.seconds
        FROM (SELECT event_id, concat('Intro text\\n0:00 Start\\n', event_id % 50 + 1, ':05 Item ', event_type, '\\n1:', lpad(event_id % 50 + 1, 2, '0'), ':00 Late\\nbye 1:00') AS description
              FROM described_events) AS e, LATERAL chapters_in(e.description) AS c""")


CHAPTERS_SQL = """
WITH e AS (SELECT event_id, event_type, event_id % 50 + 1 AS k FROM events)
SELECT event_id, 0 AS chapter_no, 'Start' AS title, '0:00' AS clock, CAST(0 AS BIGINT) AS seconds FROM e
UNION ALL SELECT event_id, 1, 'Item ' || event_type, k || ':05', k * 60 + 5 FROM e
UNION ALL SELECT event_id, 2, 'Late', '1:' || lpad(CAST(k AS VARCHAR), 2, '0') || ':00', 3600 + k * 60 FROM e
"""


def sql_amounts(spark, d):
    """Amounts of made sentences, one row each."""
    sql.register(spark)
    _view(table(spark, d, "lineitem"), "priced_lines")
    return spark.sql("""
        SELECT l_orderkey, l_linenumber, a.amount_no, a.amount
        FROM (SELECT *, concat('cost $', l_partkey, ' plus $', l_linenumber, '.5 million and more') AS body FROM priced_lines) AS p, LATERAL amounts_in(p.body) AS a""")


SQL_AMOUNTS_SQL = """
SELECT l_orderkey, l_linenumber, 0 AS amount_no, '$' || l_partkey AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 1, '$' || l_linenumber || '.5 million' FROM lineitem
"""


def sql_table_rows(spark, d):
    """Cells of HTML tables made of line items, one row per table row."""
    sql.register(spark)
    pages = page_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("<table><tr><td>"), "l_linenumber", F.lit(".<td>Part "), "l_partkey", F.lit("<tr><td>9.<td>no link</table>")).alias("html"),
    )
    _view(pages, "line_pages")
    return spark.sql("SELECT l_orderkey, l_linenumber, r.row_no, r.cells[1] AS cell FROM line_pages AS p, LATERAL html_table_rows(p.html) AS r")


TABLE_ROWS_SQL = """
SELECT l_orderkey, l_linenumber, 0 AS row_no, 'Part ' || l_partkey AS cell FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 1, 'no link' FROM lineitem
"""

QUERIES = {
    "sql_filters": (sql_filters, FILTERS_SQL),
    "sql_chapters": (sql_chapters, CHAPTERS_SQL),
    "sql_amounts": (sql_amounts, SQL_AMOUNTS_SQL),
    "sql_table_rows": (sql_table_rows, TABLE_ROWS_SQL),
}
