"""Directive, coverage, manifest, diff, video-search and HTML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.video import session_rank
from ..operators.ranges import interval_join
from ..plans import coverage, diff, directives, manifest, videos, zoning
from ..sources import html, transcripts
from .tables import meetings, page_table, spread_table, table

# --- directives ---------------------------------------------------------------


def _items(spark, d):
    """Agenda items made from orders: text by priority, file number by customer."""
    o = table(spark, d, "orders")
    pr = F.col("o_orderpriority")
    words = (
        F.when(pr == "1-URGENT", "Staff to provide a written report").when(pr == "2-HIGH", "monthly report to Council")
        .when(pr == "3-MEDIUM", "CRA staff to report quarterly report").otherwise("Approve the contract")
    )
    maker = F.concat(F.lit(" (Original motion initiated by "), F.when(F.col("o_orderstatus") == "F", "Adams").when(F.col("o_orderstatus") == "O", "Baker").otherwise("Clark"), F.lit(")"))
    return o.select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), F.concat(words, maker).alias("text"),
        F.concat(F.lit("PS25-"), F.col("o_custkey").cast("string")).alias("file_number"),
    )


def _tagged(spark, d):
    rows = directives.directive_items(_items(spark, d), "text", "date", "1996-09-01")
    return directives.tag_by_text(rows, "maker", "file_number", "text")


DIR_SQL = """
it AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS pr, 'PS25-' || o_custkey AS file_number,
  CASE o_orderstatus WHEN 'F' THEN 'Adams' WHEN 'O' THEN 'Baker' ELSE 'Clark' END AS maker FROM orders
  WHERE o_orderdate >= DATE '1996-09-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
tg AS (SELECT *, pr = '3-MEDIUM' AS is_cra, pr = '2-HIGH' AND count(*) OVER (PARTITION BY maker, file_number) > 1 AS is_rec,
  count(*) OVER (PARTITION BY maker, file_number) AS n FROM it)
"""


def directive_items(spark, d):
    t = _tagged(spark, d)
    return t.select("o_orderkey", "maker", "appearances", F.col("is_cra").cast("int").alias("is_cra"), F.col("is_recurring").cast("int").alias("is_recurring"))


def directive_counts(spark, d):
    return directives.maker_counts(_tagged(spark, d), "maker", "file_number")


def directive_sections(spark, d):
    return directives.sections(_tagged(spark, d), "maker", "file_number", "date")


def directive_markdown(spark, d):
    """The report as Markdown table rows."""
    c = directives.maker_counts(_tagged(spark, d), "maker", "file_number")
    return directives.markdown_rows(c, ["maker", "raw_count", "adjusted_count"])


def first_per_file(spark, d):
    t = directives.directive_items(_items(spark, d), "text", "date", "1996-09-01")
    return directives.first_of_each_file(t, "maker", "file_number", "date", "o_orderkey").select("maker", "file_number", "o_orderkey")


# --- coverage and volume ---------------------------------------------------------


def meeting_coverage(spark, d):
    out = coverage.coverage(meetings(spark, d), "date", "meeting_type")
    return out.withColumn("span_days", F.col("span_days").cast("bigint"))


COVERAGE_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS type, count(*) AS meetings, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
  grouping(strftime(o_orderdate, '%Y-%m'), o_orderpriority) AS level, date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS span_days
FROM orders GROUP BY GROUPING SETS ((strftime(o_orderdate, '%Y-%m')), (o_orderpriority), ())
"""


def document_volume(spark, d):
    docs = table(spark, d, "documents").withColumn("error", F.when(F.col("n_chars") < 200, "too short"))
    return coverage.document_volume(docs, ["source", "lang"], "n_chars", "error")


def document_cube(spark, d):
    return coverage.document_volume(table(spark, d, "documents"), ["source", "lang"], "n_chars", None, "cube")


VOLUME = """
SELECT CASE WHEN grouping(source) = 1 THEN '(all)' ELSE source END AS source, CASE WHEN grouping(lang) = 1 THEN '(all)' ELSE lang END AS lang,
  count(*) AS documents, CAST(coalesce(sum(n_chars) FILTER ({ok}), 0) AS BIGINT) AS bytes, count(*) FILTER (NOT ({ok})) AS errors, CAST(grouping(source, lang) AS BIGINT) AS level
FROM documents GROUP BY {how}
"""


def annual_projection(spark, d):
    o = table(spark, d, "orders")
    return coverage.annual_projection(o, "o_orderdate", "o_custkey").select("weeks", "bytes", F.round("projected_annual_bytes", 2).alias("projected_annual_bytes"))


def processing_summary(spark, d):
    docs = table(spark, d, "documents").withColumn("error", F.when(F.col("n_chars") < 300, "failed").otherwise(""))
    return coverage.processing_summary(docs.withColumn("background", F.when(F.col("lang") == "en", F.col("text"))), "source", "error", "background")


def video_totals(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("bigint").alias("seconds"))
    return coverage.video_totals(li, "l_orderkey", "seconds")


# --- manifest ----------------------------------------------------------------------


def _docs(spark, d):
    """documents as files: meeting = source rank, item = language, title made from the id."""
    p = table(spark, d, "documents")
    return p.select(
        F.lit("2025-01-02").alias("date"), (F.col("doc_id") % 20).alias("meeting_id"), F.col("lang").alias("item_id"),
        F.concat(F.lit("Doc "), (F.col("doc_id") % 97).cast("string"), F.when(F.col("doc_id") % 3 == 0, ".docx").otherwise("")).alias("title"),
        F.concat(F.lit("https://x.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.encode(F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("<!DOCTYPE html>"), F.col("text"))).otherwise(F.col("text")), "UTF-8").alias("content"),
        F.col("n_chars").alias("size"), "doc_id",
    )


def document_manifest(spark, d):
    m = manifest.manifest(_docs(spark, d), "https://files.example")
    return m.select("url", "cache_name", "key", "public_url", "content_type", "content_hash", "size", "status")


MANIFEST = """
mf AS (SELECT *, CAST(doc_id % 20 AS VARCHAR) AS m, 'doc-' || (doc_id % 97) || CASE WHEN doc_id % 3 = 0 THEN '.docx' ELSE '.pdf' END AS fn,
  CASE WHEN doc_id % 11 = 0 THEN '<!DOCTYPE html>' || text ELSE text END AS body,
  CASE WHEN doc_id % 11 = 0 AND n_chars < 10000 THEN 'failed' ELSE 'uploaded' END AS status, 'https://x.example/' || doc_id AS u FROM documents),
mk AS (SELECT *, '2025-01-02/meeting-' || m || '/' || lang || '/' || fn AS key FROM mf)
"""


def manifest_status(spark, d):
    rows = manifest.manifest(_docs(spark, d), "https://files.example")
    stored = rows.where(F.col("size") > 2000)
    return manifest.status_summary(manifest.mark_skipped(rows, stored))


def key_collisions(spark, d):
    return manifest.key_collisions(manifest.manifest(_docs(spark, d), "https://files.example"))


def carried_links(spark, d):
    """New snapshot of parts keeps the links the old one had by slug of the name."""
    p = table(spark, d, "part")
    new = p.select("p_partkey", (F.col("p_partkey") % 200).alias("item_id"), F.upper("p_name").alias("title"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("mirrored_url"))
    old = p.select((F.col("p_partkey") % 200).alias("item_id"), F.concat("p_name", F.lit("!")).alias("title"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("old-"), "p_brand")).alias("mirrored_url"))
    return manifest.carry_links(new, old).select("p_partkey", "mirrored_url")


CARRY_SQL = """
WITH o AS (SELECT p_partkey % 200 AS item_id, replace(p_name, ' ', '-') AS s, min('old-' || p_brand) AS u FROM part WHERE p_size % 3 = 0 GROUP BY 1, 2)
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE u END AS mirrored_url FROM part LEFT JOIN o ON o.item_id = p_partkey % 200 AND o.s = replace(p_name, ' ', '-')
"""


def resolved_links(spark, d):
    """Line items as document links resolved to the order's other lines in three tiers."""
    li = table(spark, d, "lineitem")
    items = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p")).select(
        "l_orderkey", F.concat(F.lit("7"), F.col("l_linenumber").cast("string")).alias("item_id"), F.col("l_linenumber").alias("item_no"),
        F.concat(F.lit("Item about-part "), F.col("p").cast("string")).alias("text"),
    )
    links = li.select(
        "l_orderkey", F.concat_ws("/", "l_partkey", "l_suppkey", "l_linenumber").alias("link_id"),
        F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("17"), F.col("l_linenumber").cast("string"))).otherwise("x").alias("number"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("ABOUT-PART "), F.col("l_partkey").cast("string"))).otherwise(F.concat(F.lit("about part"), F.col("l_partkey").cast("string"))).alias("text"),
    )
    return manifest.link_items(links.distinct(), items, "l_orderkey").select("l_orderkey", "link_id", "item_id", "tier")


LINKS_SQL = """
WITH i AS (SELECT l_orderkey, '7' || l_linenumber AS item_id, l_linenumber AS item_no, 'item about-part ' || min(l_partkey) AS t FROM lineitem GROUP BY l_orderkey, l_linenumber),
k AS (SELECT DISTINCT l_orderkey, l_partkey || '/' || l_suppkey || '/' || l_linenumber AS link_id, CASE WHEN l_partkey % 2 = 0 THEN '17' || l_linenumber ELSE 'x' END AS num,
  CASE WHEN l_partkey % 3 = 0 THEN 'about-part ' || l_partkey ELSE 'about part' || l_partkey END AS t FROM lineitem),
h AS (SELECT k.l_orderkey, link_id, i.item_id, item_no, CASE WHEN contains(i.item_id, num) OR contains(num, i.item_id) THEN 1 WHEN contains(i.t, k.t) THEN 2
   WHEN contains(regexp_replace(i.t, '[^a-z0-9]', '', 'g'), regexp_replace(k.t, '[^a-z0-9]', '', 'g')) THEN 3 END AS tier FROM k JOIN i USING (l_orderkey)),
b AS (SELECT l_orderkey, link_id, arg_min(item_id, (tier, item_no)) AS item_id, min(tier) AS tier FROM h WHERE tier IS NOT NULL GROUP BY 1, 2)
SELECT k.l_orderkey, k.link_id, b.item_id, b.tier FROM k LEFT JOIN b USING (l_orderkey, link_id)
"""


# --- snapshot diff --------------------------------------------------------------------


def _snapshots(spark, d):
    """Orders as nested meetings, and a copy with edits decided by the key."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    lines = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"))
    items = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "part", "supp"))).alias("x"))
    base = o.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    item = lambda x, extra: F.struct(x["l_linenumber"].alias("number"), (x["part"] + extra).alias("part"), F.concat(F.lit("u"), (x["supp"] + extra).cast("string")).alias("url"))
    old = base.select("o_orderkey", F.col("o_orderpriority").alias("title"), F.transform("x", lambda x: item(x, F.lit(0))).alias("agendaItems"))
    k = F.col("o_orderkey") % 10
    added = F.array(F.struct(F.lit(99).alias("number"), F.lit(1).cast("bigint").alias("part"), F.lit("u1").alias("url")))
    new_items = F.transform("x", lambda x: item(x, F.when((k == 1) & (x["l_linenumber"] == 2), 1).otherwise(F.lit(0))))
    new = base.select(
        "o_orderkey",
        F.when(k == 0, F.lit(None).cast("string")).when(k == 2, F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")).alias("title"),
        F.when(k == 3, F.concat(new_items, added)).when(k == 4, F.slice(new_items, 1, F.size("x") - 1)).otherwise(new_items).alias("agendaItems"),
    )
    return old, new


def snapshot_changes(spark, d):
    old, new = _snapshots(spark, d)
    out = diff.snapshot_diff(old, new, "o_orderkey")
    return out.select("o_orderkey", "path", "change", F.when(F.col("change") != "array_item_added", F.col("old")).alias("old"), F.when(F.col("change") != "array_item_added", F.col("new")).alias("new"))


SNAP = """
ln AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS part, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i FROM lineitem GROUP BY 1, 2),
cn AS (SELECT k, count(*) AS c FROM ln GROUP BY 1)
"""
CHANGES = SNAP + """,
ch AS (
 SELECT o_orderkey, 'title' AS path, 'field_removed' AS change, o_orderpriority AS old, CAST(NULL AS VARCHAR) AS new FROM orders JOIN cn ON k = o_orderkey WHERE o_orderkey % 10 = 0
 UNION ALL SELECT o_orderkey, 'title', 'value_change', o_orderpriority, o_orderpriority || '!' FROM orders JOIN cn ON k = o_orderkey WHERE o_orderkey % 10 = 2
 UNION ALL SELECT k, 'agendaItems[' || i || '].part', 'value_change', CAST(part AS VARCHAR), CAST(part + 1 AS VARCHAR) FROM ln WHERE k % 10 = 1 AND n = 2
 UNION ALL SELECT k, 'agendaItems', 'array_length_change', CAST(c AS VARCHAR), CAST(c + CASE WHEN k % 10 = 3 THEN 1 ELSE -1 END AS VARCHAR) FROM cn WHERE k % 10 IN (3, 4)
 UNION ALL SELECT k, 'agendaItems[' || c || ']', 'array_item_added', NULL, NULL FROM cn WHERE k % 10 = 3)
"""


def change_summary(spark, d):
    old, new = _snapshots(spark, d)
    out = diff.change_summary(diff.snapshot_diff(old, new, "o_orderkey"), "o_orderkey", documents="agendaItems")
    return out.select("o_orderkey", "item_index", "new_documents", F.array_join("changed_fields", ",").alias("changed_fields"))


# --- video search ----------------------------------------------------------------------


def interval_candidates(spark, d):
    """Events from one day before to four days after a shifted order date, same user."""
    users = table(spark, d, "events").select("event_id", F.col("user_id").alias("u"), "ts")
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 100).alias("u"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 28).cast("int")).alias("date"))
    out = interval_join(o, users, "date", "ts", 1, 4, ["u"])
    return out.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("candidates"), F.min("event_id").alias("first_event"))


INTERVAL_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey % 100 AS u, DATE '2024-01-01' + CAST(o_orderkey % 28 AS INTEGER) AS dt FROM orders)
SELECT o_orderkey, count(*) AS candidates, min(event_id) AS first_event FROM o JOIN events e ON e.user_id = o.u
  AND CAST(e.ts AS DATE) >= o.dt - 1 AND CAST(e.ts AS DATE) <= o.dt + 4 GROUP BY 1
"""


def _listing(spark, d):
    """events as published videos with the day in their title."""
    e = table(spark, d, "events")
    n = F.col("event_id") % 4
    day = F.when(n == 0, F.date_format("ts", "MM/dd/yyyy")).when(n == 1, F.date_format("ts", "M-d-yyyy")).when(n == 2, F.date_format("ts", "MM-dd-yy")).otherwise(F.date_format("ts", "M/d/yy"))
    show = F.when(F.col("event_type") == "error", "TCC").when(F.col("event_type") == "view", "Community Redevelopment").otherwise("City Council")
    pm = F.when(F.col("user_id") % 3 == 0, " PM").otherwise("")
    return e.select(
        F.col("event_id").alias("video_id"), F.concat(show, pm, F.lit(" "), day).alias("title"), F.lit("0:00 Start").alias("description"), F.col("ts").alias("published_at"),
        F.concat(F.lit("PT"), (F.col("event_id") % 60).cast("string"), F.lit("M")).alias("duration"),
    )


def _days(spark, d):
    """One meeting per day and label."""
    e = table(spark, d, "events")
    label = F.explode(F.array(*[F.lit(x) for x in ("CRA", "Workshop", "Evening", "Special")])).alias("label")
    days = e.select(F.to_date("ts").alias("date")).distinct().select("date", label)
    return days.withColumn("meeting_id", F.concat_ws(" ", F.col("date").cast("string"), "label"))


def video_candidates(spark, d):
    found = videos.candidates(_days(spark, d), _listing(spark, d), videos.search_terms(spark))
    return found.select("meeting_id", "video_id", "priority", "part", "session")


def videos_found(spark, d):
    """After the session filter, with the running order."""
    found = videos.find(_days(spark, d), _listing(spark, d))
    return found.select("meeting_id", "video_id", "part", session_rank("session").alias("session_rank"))


CAND = """
dy AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
mt AS (SELECT date, label, strftime(date, '%Y-%m-%d') || ' ' || label AS meeting_id FROM dy, (VALUES ('CRA'), ('Workshop'), ('Evening'), ('Special')) l(label)),
tm AS (SELECT * FROM (VALUES ('CRA', 'community redevelopment', 0), ('CRA', 'tcc', 1), ('CRA', 'cra', 2), ('Workshop', 'city council', 0), ('Workshop', 'tcc', 1), ('Workshop', 'charter workshop', 2),
  ('Evening', 'city council', 0), ('Evening', 'tcc', 1), ('Special', 'city council', 0), ('Special', 'tcc', 1)) t(label, term, priority)),
ls AS (SELECT event_id AS video_id, ts, lower(CASE event_type WHEN 'error' THEN 'TCC' WHEN 'view' THEN 'Community Redevelopment' ELSE 'City Council' END || CASE WHEN user_id % 3 = 0 THEN ' PM' ELSE '' END || ' ' ||
  CASE event_id % 4 WHEN 0 THEN strftime(ts, '%m/%d/%Y') WHEN 1 THEN strftime(ts, '%-m-%-d-%Y') WHEN 2 THEN strftime(ts, '%m-%d-%y') ELSE strftime(ts, '%-m/%-d/%y') END) AS title FROM events WHERE event_id % 60 >= 10),
nr AS (SELECT mt.*, ls.* FROM mt JOIN ls ON CAST(ls.ts AS DATE) BETWEEN mt.date - 1 AND mt.date + 4
  AND (contains(ls.title, strftime(mt.date, '%m/%d/%Y'))
  OR contains(ls.title, strftime(mt.date, '%-m/%-d/%Y'))
  OR contains(ls.title, strftime(mt.date, '%m/%d/%y'))
  OR contains(ls.title, strftime(mt.date, '%-m/%-d/%y'))
  OR contains(ls.title, strftime(mt.date, '%m-%d-%Y'))
  OR contains(ls.title, strftime(mt.date, '%-m-%-d-%Y'))
  OR contains(ls.title, strftime(mt.date, '%m-%d-%y'))
  OR contains(ls.title, strftime(mt.date, '%-m-%-d-%y')))),
wt AS (SELECT nr.*, tm.priority FROM nr JOIN tm ON nr.label = tm.label AND contains(nr.title, tm.term)),
fs AS (SELECT meeting_id, min(priority) AS priority FROM wt GROUP BY 1),
cd AS (SELECT DISTINCT wt.meeting_id, wt.label, video_id, wt.priority, CASE WHEN title LIKE '% pm %' THEN 'evening' END AS session FROM wt JOIN fs USING (meeting_id, priority))
"""

# --- pages -------------------------------------------------------------------------------


def page_lines(spark, d):
    p = spread_table(spark, d, "pages")
    rows = p.select("page_id", html.page_lines("html").alias("lines"))
    return rows.select("page_id", F.size("lines").cast("bigint").alias("lines"), F.md5(F.array_join("lines", "\n")).alias("text_md5"))


LINES_SQL = r"""
WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(t, '(?i)<(?:/?(?:p|div|li|ul|ol|tr|td|th|table|h[1-6]|article|nav|section|title|body|head|html)\b[^>]*|br\b[^>]*)>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM b),
l AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(12) || chr(160))), lambda x: length(x) > 0) AS ls FROM c)
SELECT page_id, CAST(len(ls) AS BIGINT) AS lines, md5(array_to_string(ls, chr(10))) AS text_md5 FROM l
"""


def page_links(spark, d):
    p = spread_table(spark, d, "pages")
    return html.links(p, "/", ["page_id"]).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", F.md5("text").alias("text_md5"))


LINKS_PAGE_SQL = r"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*[^>]*>.*?</a\s*>')) AS tag, generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*[^>]*>.*?</a\s*>'), 1) AS n FROM pages),
h AS (SELECT page_id, n, replace(regexp_extract(tag, '(?is)^<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1), '&amp;', '&') AS href,
  trim(replace(replace(replace(replace(regexp_replace(tag, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS t FROM a)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS pos, href, md5(t) AS text_md5 FROM h WHERE contains(href, '/')
"""


def page_facts(spark, d):
    """Title, date, agenda type and addendum flag; the heading is put in front of each page."""
    p = page_table(spark, d, "pages")
    kind = F.when(F.col("page_id") % 3 == 0, "R E G U L A R  F I N A L  A G E N D A").when(F.col("page_id") % 3 == 1, "D R A F T").otherwise("Agenda")
    extra = F.when(F.col("page_id") % 5 == 0, "<p>Addendum  to Final\n Agenda</p>").otherwise("")
    top = F.concat(F.lit("<h1>"), kind, F.lit("</h1><span>Thursday, March "), (F.col("page_id") % 28 + 1).cast("string"), F.lit(", 2026</span>"), extra)
    facts = html.page_facts(p.withColumn("html", F.concat(top, "html")), ["page_id"])
    return facts.select("page_id", "date", "agenda_type", F.col("is_addendum").cast("int").alias("is_addendum"))


def agenda_table_rows(spark, d):
    """Agenda rows parsed from tables made of line items, in three shapes of markup."""
    li = page_table(spark, d, "lineitem")
    shape = F.col("l_linenumber") % 3  # with a heading row, without end tags, with a table inside the cell
    head = F.when(shape == 0, "<table><thead><tr><th>No.</th><th>Item</th></tr></thead><tbody><tr><td>").otherwise("<table><tr><td>")
    inner = F.when(shape == 2, "<table><tr><td></td><td></td></tr></table>").otherwise("")
    tail = F.when(shape == 1, ",1)\">open</a><tr><td>9.<td>no link</table>").otherwise(",1)\">open</a></td></tr></tbody></table>")
    row = F.concat(
        head, F.col("l_linenumber").cast("string"), F.when(shape == 1, ".<td>").otherwise(".</td><td>"), F.lit("File No. PS25-"), F.col("l_partkey").cast("string"),
        inner, F.lit(" <a id=\"lnk"), F.col("l_suppkey").cast("string"), F.lit("\" href=\"javascript:loadAgendaItem("), F.col("l_suppkey").cast("string"), tail,
    )
    pages = li.select("l_orderkey", row.alias("html"))
    return html.agenda_rows(pages, "l_orderkey").select("l_orderkey", "number", "agenda_item_id", "link_id", "file_number", "raw_text")


AGENDA_SQL = """
SELECT l_orderkey, l_linenumber AS number, CAST(l_suppkey AS VARCHAR) AS agenda_item_id, 'lnk' || l_suppkey AS link_id, 'PS25-' || l_partkey AS file_number,
  'File No. PS25-' || l_partkey || ' open' AS raw_text FROM lineitem
"""


def meeting_list(spark, d):
    """Meeting-list rows parsed from tables made of orders, one page per order."""
    o = page_table(spark, d, "orders")
    link = F.when(F.col("o_orderstatus") == "P", "<a href=\"/s?doctype=3\">Summary</a>").otherwise(F.concat(F.lit("<a href=\"/ViewMeeting?id="), F.col("o_orderkey").cast("string"), F.lit("&amp;doctype=1\">Agenda</a>")))
    name = F.when(F.col("o_orderpriority") == "1-URGENT", "Evening CRA").when(F.col("o_orderpriority") == "2-HIGH", "Special").otherwise("Council")
    row = F.concat(F.lit("<tr data-meeting-id=\""), F.col("o_orderkey").cast("string"), F.lit("\"><td>"), name, F.lit("</td><td>"), link, F.lit("</td></tr>"))
    pages = o.select("o_custkey", F.concat(F.lit("<table>"), row, F.lit("</table>")).alias("html"))
    return html.meeting_list_rows(pages, "o_custkey", "https://records.example.org")


LIST_SQL = """
SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'evening' WHEN '2-HIGH' THEN 'special' ELSE 'regular' END AS type,
  'https://records.example.org/ViewMeeting?id=' || o_orderkey || '&doctype=1' AS href FROM orders WHERE o_orderstatus <> 'P'
"""


def transcript_index(spark, d):
    """Grid rows of a transcript index made of orders; bad dates are dropped."""
    o = page_table(spark, d, "orders")
    day = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    name = F.when(F.col("o_orderpriority") == "1-URGENT", "Evening CRA").when(F.col("o_orderpriority") == "2-HIGH", "Workshop").otherwise("Council")
    row = F.concat(F.lit("<tr><td>"), day, F.lit("</td><td>"), name, F.lit("</td><td><a href='/t?pkey="), F.col("o_orderkey").cast("string"), F.lit("'>read</a></td></tr>"))
    pages = o.select("o_custkey", F.concat(F.lit("<table>"), row, F.lit("</table>")).alias("html"))
    return html.transcript_index_rows(pages, "o_custkey")


INDEX_SQL = """
SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS pkey, CAST(o_orderdate AS DATE) AS date, CASE o_orderpriority WHEN '1-URGENT' THEN 'Evening CRA' WHEN '2-HIGH' THEN 'Workshop' ELSE 'Council' END AS title,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'cra' WHEN '2-HIGH' THEN 'workshop' ELSE 'regular' END AS meeting_type FROM orders WHERE o_orderstatus <> 'P'
"""


def item_pages(spark, d):
    """Title, background, documents and heading type of item pages made from orders."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey").cast("string")
    page = F.concat(
        F.lit("<h1>City Records</h1><h1>"), F.col("o_orderpriority"), F.lit("</h1><div class=\"item-view-title-text\">Order <b>"), k, F.lit("</b></div><div>Background: owed by "), F.col("o_custkey").cast("string"),
        F.lit("</div><div>Fiscal none</div><a title=\"Sheet\" href=\"/DownloadFile?id="), k, F.lit("&amp;x=1\">Summary Sheet</a><a href=\"/DownloadFileBytes?id=2\"></a>"),
    )
    pages = o.select("o_orderkey", page.alias("html"))
    docs = html.supporting_documents(pages, ["o_orderkey"], "https://records.example.org").groupBy("o_orderkey").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "doc_pos", "title", "url"))), " ").alias("documents")
    )
    heads = pages.select("o_orderkey", html.heading_meeting_type("html", "City Records").alias("heading"))
    return html.item_details(pages, ["o_orderkey"]).select("o_orderkey", "title", "background").join(docs, "o_orderkey").join(heads, "o_orderkey")


ITEM_SQL = """
SELECT o_orderkey, 'Order ' || o_orderkey AS title, 'owed by ' || o_custkey AS background,
  '0|Summary Sheet|https://records.example.org/DownloadFileBytes?id=' || o_orderkey || '&x=1 1|Document|https://records.example.org/DownloadFileBytes?id=2' AS documents, o_orderpriority AS heading FROM orders
"""


def transcript_pages(spark, d):
    """Header fields and speaker segments of transcript pages, one page per conversation turn."""
    c = spread_table(spark, d, "conversations")
    stamp = F.concat(F.lit("9:"), F.lpad(F.col("turn").cast("string"), 2, "0"))
    page = F.concat(
        F.lit("SPRING CITY COUNCIL\nTHURSDAY, OCTOBER 23, 2025, 9:00 A.M.\nDISCLAIMER:\nnot official\nfor reading only\n"),
        stamp, F.lit(":00AM >>"), F.upper("role"), F.lit(": opening\n"), F.regexp_replace("text", r"\s+", " "),
        F.lit("\n9:59:59AM >> nobody\nSkip to content\n"), stamp, F.lit(":30AM >>CHAIR:\nthank\nyou\n"), stamp, F.lit(":40AM >>CLERK:\n"),
    )
    pages = c.select("conv_id", "turn", page.alias("t"))
    out = transcripts.parse_pages(pages, html.lines_of(F.col("t")), ["conv_id", "turn"], "CITY COUNCIL")
    head = ["conv_id", "turn", "meeting_title", "meeting_date_time", "disclaimer", "segment_count"]
    rows = out.select(*head, F.posexplode("segments").alias("i", "s"))
    return rows.select(*head, F.col("i").alias("segment_index"), "s.timestamp", "s.speaker", F.md5("s.text").alias("text_md5"))


TRANSCRIPT_SQL = r"""
WITH h AS (SELECT conv_id, turn, 'SPRING CITY COUNCIL' AS meeting_title, 'THURSDAY, OCTOBER 23, 2025, 9:00 A.M.' AS meeting_date_time, 'not official for reading only' AS disclaimer,
  2 AS segment_count, '9:' || lpad(CAST(turn AS VARCHAR), 2, '0') AS st, role, text FROM conversations)
SELECT conv_id, turn, meeting_title, meeting_date_time, disclaimer, segment_count, 0 AS segment_index, st || ':00AM' AS timestamp, upper(role) AS speaker,
  md5(trim('opening ' || trim(regexp_replace(text, '\s+', ' ', 'g')))) AS text_md5 FROM h
UNION ALL SELECT conv_id, turn, meeting_title, meeting_date_time, disclaimer, segment_count, 1, st || ':30AM', 'CHAIR', md5('thank you') FROM h
"""


# --- staff reports, exports, maps -------------------------------------------------------------


def _reports(spark, d):
    """Land-use items made of parts, with lines as their documents."""
    p = table(spark, d, "part")
    fn = F.concat(F.when(F.col("p_size") % 3 == 0, "REZ-25-").when(F.col("p_size") % 3 == 1, "VAC-25-").otherwise("PS25-"), F.col("p_partkey").cast("string"))
    items = p.select("p_partkey", fn.alias("file_number"), F.col("p_name").alias("title"))
    kind = F.when(F.col("l_returnflag") == "A", "Notice ").otherwise("Staff Report Final ")
    docs = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.concat(kind, F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "MM.dd.yy")).otherwise(F.repeat(F.lit("x"), F.col("l_linenumber")))).alias("doc_title"),
        (F.col("l_orderkey") * (1 << 24) + F.col("l_suppkey")).alias("doc_pos"), F.concat_ws("/", "l_orderkey", "l_linenumber", "l_suppkey").alias("url"),
    )
    return items, docs


def latest_reports(spark, d):
    """Newest final staff report of each land-use item."""
    items, docs = _reports(spark, d)
    return zoning.latest_reports(items, docs, ["p_partkey"]).select("p_partkey", "land_use_type", "doc_title")


def attached_reports(spark, d):
    """Every part with the report of its item, if it has one."""
    items, docs = _reports(spark, d)
    found = zoning.latest_reports(items, docs, ["p_partkey"]).select("p_partkey", "doc_title", "land_use_type")
    out = zoning.attach_reports(items, found, "p_partkey")
    return out.select("p_partkey", "file_number", F.col("staff_report.land_use_type").alias("land_use_type"), F.col("staff_report.doc_title").alias("doc_title"))


REPORTS = """
dc AS (SELECT l_partkey AS p_partkey, CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS dt, 'Staff Report Final ' || CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%m.%d.%y') ELSE repeat('x', l_linenumber) END AS doc_title
  FROM lineitem WHERE l_returnflag <> 'A'),
dy AS (SELECT *, CASE WHEN dt IS NOT NULL THEN make_date(2000 + CAST(strftime(dt, '%y') AS INTEGER), CAST(month(dt) AS INTEGER), CAST(day(dt) AS INTEGER)) END AS rd FROM dc),
bs AS (SELECT p_partkey, arg_max(doc_title, (rd IS NOT NULL, coalesce(rd, DATE '1900-01-01'), length(doc_title))) AS doc_title FROM dy GROUP BY 1),
lr AS (SELECT p.p_partkey, CASE p_size % 3 WHEN 0 THEN 'REZONING' WHEN 1 THEN 'VACATION' END AS land_use_type, doc_title FROM part p JOIN bs USING (p_partkey) WHERE p_size % 3 < 2)
"""


def extension_totals(spark, d):
    docs = table(spark, d, "documents").withColumn("name", F.concat(F.col("source"), F.when(F.col("doc_id") % 3 == 0, ".DOCX").when(F.col("doc_id") % 3 == 1, ".pdf").otherwise("")))
    return coverage.by_extension(docs.withColumn("name", F.regexp_replace("name", r"^[^.]*", "x")), "name", "n_chars")


def json_export(spark, d):
    """Meetings written as JSON lines and read back with an explicit schema; empty values stay out."""
    from .streams import _scratch

    out = _scratch(spark)
    p = table(spark, d, "part")
    amounts = F.when(F.col("p_size") % 2 == 0, F.array(F.concat(F.lit("$"), F.col("p_size").cast("string"))))
    p.select("p_partkey", "p_name", amounts.alias("amounts")).write.json(out)
    back = spark.read.schema("p_partkey bigint, p_name string, amounts array<string>").json(out)
    return back.select("p_partkey", "p_name", F.to_json("amounts").alias("amounts"))


def map_rows(spark, d):
    """JSON maps of events as rows, summed per key."""
    e = table(spark, d, "events").select("event_type", F.explode(F.from_json("props", "map<string,bigint>")).alias("name", "value"))
    return e.groupBy("event_type", "name").agg(F.count(F.lit(1)).alias("entries"), F.sum("value").alias("total"))


QUERIES = {
    "directive_items": (
        directive_items,
        f"WITH {DIR_SQL} SELECT o_orderkey, maker, n AS appearances, CAST(is_cra AS INTEGER) AS is_cra, CAST(is_rec AS INTEGER) AS is_recurring FROM tg",
    ),
    "directive_counts": (
        directive_counts,
        f"""WITH {DIR_SQL} SELECT maker, count(*) AS raw_count, CAST(count(*) FILTER (NOT is_cra AND NOT is_rec) + count(DISTINCT file_number) FILTER (is_rec) AS BIGINT) AS adjusted_count,
            count(*) FILTER (NOT is_cra AND NOT is_rec) AS one_time, count(*) FILTER (is_rec) AS recurring_items, count(DISTINCT file_number) FILTER (is_rec) AS recurring_files,
            count(*) FILTER (is_cra) AS excluded FROM tg GROUP BY 1""",
    ),
    "directive_sections": (
        directive_sections,
        f"""WITH {DIR_SQL} SELECT maker, CASE WHEN is_cra THEN 'excluded' WHEN is_rec THEN 'recurring' ELSE 'one_time' END AS section, file_number, count(*) AS appearances,
            min(date) AS first_date, max(date) AS last_date FROM tg GROUP BY ALL""",
    ),
    "directive_markdown": (
        directive_markdown,
        f"""WITH {DIR_SQL} SELECT '| ' || maker || ' | ' || count(*) || ' | ' || (count(*) FILTER (NOT is_cra AND NOT is_rec) + count(DISTINCT file_number) FILTER (is_rec)) || ' |' AS value FROM tg GROUP BY maker""",
    ),
    "first_per_file": (
        first_per_file,
        f"WITH {DIR_SQL} SELECT maker, file_number, arg_min(o_orderkey, (date, o_orderkey)) AS o_orderkey FROM it GROUP BY 1, 2",
    ),
    "meeting_coverage": (meeting_coverage, COVERAGE_SQL),
    "document_volume": (document_volume, VOLUME.format(ok="n_chars >= 200", how="ROLLUP (source, lang)")),
    "document_cube": (document_cube, VOLUME.format(ok="true", how="CUBE (source, lang)")),
    "annual_projection": (
        annual_projection,
        """WITH w AS (SELECT date_trunc('week', o_orderdate) AS w, sum(o_custkey) AS b FROM orders GROUP BY 1)
           SELECT count(*) AS weeks, CAST(sum(b) AS BIGINT) AS bytes, round(sum(b) / count(*) * 52, 2) AS projected_annual_bytes FROM w""",
    ),
    "processing_summary": (
        processing_summary,
        """SELECT source, count(*) AS items, count(*) FILTER (n_chars >= 300) AS succeeded, count(*) FILTER (n_chars < 300) AS failed,
           count(*) FILTER (lang = 'en' AND length(text) > 0) AS with_background FROM documents GROUP BY 1""",
    ),
    "video_totals": (video_totals, "SELECT l_orderkey, count(*) AS videos, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_seconds FROM lineitem GROUP BY 1"),
    "document_manifest": (
        document_manifest,
        f"""WITH {MANIFEST} SELECT u AS url, md5(u) AS cache_name, key, 'https://files.example/' || key AS public_url,
            CASE WHEN doc_id % 3 = 0 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' ELSE 'application/pdf' END AS content_type,
            substr(sha256(body), 1, 12) AS content_hash, n_chars AS size, status FROM mk""",
    ),
    "manifest_status": (
        manifest_status,
        f"""WITH {MANIFEST}, st AS (SELECT DISTINCT key, sha256(body) AS h FROM mk WHERE n_chars > 2000),
            j AS (SELECT mk.*, CASE WHEN st.key IS NOT NULL THEN 'skipped' ELSE status END AS s2 FROM mk LEFT JOIN st ON mk.key = st.key AND sha256(mk.body) = st.h)
            SELECT doc_id % 20 AS meeting_id, count(DISTINCT lang) AS items_with_docs, count(*) FILTER (s2 = 'uploaded') AS uploaded, count(*) FILTER (s2 = 'skipped') AS skipped,
            count(*) FILTER (s2 = 'failed') AS failed FROM j GROUP BY 1""",
    ),
    "key_collisions": (key_collisions, f"WITH {MANIFEST} SELECT key, count(*) AS documents FROM mk GROUP BY 1 HAVING count(*) > 1"),
    "carried_links": (carried_links, CARRY_SQL),
    "resolved_links": (resolved_links, LINKS_SQL),
    "snapshot_changes": (snapshot_changes, f"WITH {CHANGES} SELECT * FROM ch"),
    "change_summary": (
        change_summary,
        f"""WITH {SNAP} SELECT k AS o_orderkey, CAST(i AS INTEGER) AS item_index, CAST(0 AS BIGINT) AS new_documents, 'part' AS changed_fields FROM ln WHERE k % 10 = 1 AND n = 2
            UNION ALL SELECT k, CAST(c AS INTEGER), 1, '' FROM cn WHERE k % 10 = 3""",
    ),
    "interval_candidates": (interval_candidates, INTERVAL_SQL),
    "video_candidates": (video_candidates, f"WITH {CAND} SELECT meeting_id, video_id, priority, 1 AS part, session FROM cd"),
    "videos_found": (
        videos_found,
        f"""WITH {CAND}, kp AS (SELECT *, CASE label WHEN 'CRA' THEN true WHEN 'Special' THEN true WHEN 'Evening' THEN session IS NOT NULL ELSE session IS NULL END AS keep FROM cd),
            ak AS (SELECT *, bool_or(keep) OVER (PARTITION BY meeting_id) AS any_kept FROM kp)
            SELECT meeting_id, video_id, 1 AS part, CASE WHEN session = 'evening' THEN 3 ELSE 99 END AS session_rank FROM ak WHERE keep OR NOT any_kept""",
    ),
    "page_lines": (page_lines, LINES_SQL),
    "page_links": (page_links, LINKS_PAGE_SQL),
    "page_facts": (
        page_facts,
        """SELECT page_id, make_date(2026, 3, page_id % 28 + 1) AS date, CASE WHEN page_id % 3 = 0 THEN 'FINAL' ELSE 'DRAFT' END AS agenda_type,
           CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS is_addendum FROM pages""",
    ),
    "agenda_table_rows": (agenda_table_rows, AGENDA_SQL),
    "meeting_list": (meeting_list, LIST_SQL),
    "transcript_index": (transcript_index, INDEX_SQL),
    "item_pages": (item_pages, ITEM_SQL),
    "transcript_pages": (transcript_pages, TRANSCRIPT_SQL),
    "latest_reports": (latest_reports, f"WITH {REPORTS} SELECT * FROM lr"),
    "attached_reports": (
        attached_reports,
        f"""WITH {REPORTS} SELECT p.p_partkey, CASE p_size % 3 WHEN 0 THEN 'REZ-25-' WHEN 1 THEN 'VAC-25-' ELSE 'PS25-' END || p.p_partkey AS file_number, lr.land_use_type, lr.doc_title
            FROM part p LEFT JOIN lr USING (p_partkey)""",
    ),
    "extension_totals": (
        extension_totals,
        "SELECT CASE WHEN doc_id % 3 = 0 THEN '.docx' ELSE '.pdf' END AS extension, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1",
    ),
    "json_export": (json_export, "SELECT p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN '[\"$' || p_size || '\"]' END AS amounts FROM part"),
    "map_rows": (
        map_rows,
        """SELECT event_type, 'k' AS name, count(*) AS entries, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1""",
    ),
}
