"""Warehouse, read-model and discovery queries over orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..functions.base import blank_to_null, first_present, zero_to_null
from ..functions.text import default_title
from ..operators import keyed
from ..operators.sequence import Position, Sequence
from ..plans import discover, readmodel, warehouse
from .tables import meetings, raw_table, table

M_SQL = """
m AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS meeting_type, o_custkey, o_orderstatus,
             coalesce(n, 0) AS item_count
      FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
"""


def _agendas(spark, d):
    return meetings(spark, d).where(F.col("o_orderstatus") != "P")


def _transcripts(spark, d):
    t = meetings(spark, d).where(F.col("o_orderstatus") == "P")
    return t.select(F.col("id").cast("string").alias("transcript_id"), "date", "meeting_type")


AT_SQL = M_SQL + """,
a AS (SELECT * FROM m WHERE o_orderstatus <> 'P'),
t AS (SELECT id AS tid, date, meeting_type FROM m WHERE o_orderstatus = 'P'),
best AS (SELECT date, meeting_type, arg_max(id, (item_count, -id)) AS id FROM a GROUP BY 1, 2),
g AS (SELECT date, meeting_type, min(tid) AS first_id, max(tid) AS last_id FROM t GROUP BY 1, 2),
own AS (SELECT g.*, coalesce(b.id, -first_id - 1) AS id, b.id IS NULL AS stub FROM g LEFT JOIN best b USING (date, meeting_type))
"""


def item_counts(spark, d):
    """Items per meeting; what would be the length of its array."""
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("meeting_id")).agg(F.count(F.lit(1)).alias("item_count"))


def _placed_lines(spark, d):
    """Lines with a dense place inside their order."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    return Sequence(["l_orderkey"], order, order).apply(li, pos=Position())


def keep_fullest(spark, d):
    slim = meetings(spark, d).select("date", "meeting_type", "id", "item_count")
    return warehouse.keep_fullest(slim)


def match_transcripts(spark, d):
    """Meetings with the transcript they were given."""
    full, _, _ = warehouse.match_transcripts(_agendas(spark, d), _transcripts(spark, d))
    return full.where(F.col("transcript_source_id").isNotNull() & ~F.col("is_stub")).select(
        "id", "date", "meeting_type", "item_count", "transcript_source_id"
    )


def transcript_stubs(spark, d):
    """Stub meetings for transcripts without an agenda."""
    full, _, _ = warehouse.match_transcripts(_agendas(spark, d), _transcripts(spark, d))
    return full.where("is_stub").select("id", "date", "meeting_type", "title", "item_count", "transcript_source_id")


def superseded_transcripts(spark, d):
    _, _, lost = warehouse.match_transcripts(_agendas(spark, d), _transcripts(spark, d))
    return lost


def matching_stats(spark, d):
    full, links, lost = warehouse.match_transcripts(_agendas(spark, d), _transcripts(spark, d))
    return warehouse.run_stats(full, links, lost)


def cascade_delete(spark, d):
    """Lines of the meetings that survive the de-duplication."""
    kept = warehouse.keep_fullest(meetings(spark, d).select("date", "meeting_type", "id", "item_count")).select(F.col("id").alias("l_orderkey"))
    out = keyed.keep_referenced(table(spark, d, "lineitem"), kept, ["l_orderkey"])
    return out.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("items"), F.sum("l_linenumber").alias("line_sum"))


def newest_document(spark, d):
    """One order per customer, the last in name order, before its lines are unnested."""
    o = table(spark, d, "orders").withColumn("file_name", F.concat_ws("_", F.lit("meeting"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")))
    docs = warehouse.latest_documents(o.select(F.col("o_custkey").alias("meetingId"), "file_name", "o_orderkey"))
    items = docs.join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return items.groupBy("meetingId", "file_name").agg(F.count(F.lit(1)).alias("items"))


def infer_types(spark, d):
    """Meeting type from file-number prefixes; numbers are made from line flags."""
    li = table(spark, d, "lineitem")
    prefix = F.when(F.col("l_returnflag") == "A", "CRA").when(F.col("l_returnflag") == "N", "REZ").otherwise("PS")
    items = li.select(F.col("l_orderkey").alias("meeting_id"), F.concat(prefix, F.lit("-25-"), F.col("l_partkey").cast("string")).alias("fileNumber"))
    return warehouse.infer_types(items)


def transcript_types(spark, d):
    """Type by override, video listing, title and time; counted per type."""
    o = table(spark, d, "orders")
    tr = o.select(
        F.col("o_orderkey").cast("string").alias("transcript_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CITY COUNCIL WORKSHOPS").when(F.col("o_orderpriority") == "2-HIGH", "COMMUNITY REDEVELOPMENT AGENCY").otherwise("CITY COUNCIL").alias("meeting_title"),
        F.when(F.col("o_orderstatus") == "F", "5:01 P.M.").when(F.col("o_orderstatus") == "O", "9:00 A.M.").alias("meeting_date_time"),
    )
    maps = o.where(F.col("o_custkey") % 5 == 0).select(
        F.col("o_orderkey").alias("meeting_id"),
        F.when(F.col("o_orderstatus") == "F", "Evening").when(F.col("o_orderstatus") == "O", "CRA").otherwise("Gala").alias("meeting_type"),
    )
    overrides = o.where(F.col("o_custkey") % 11 == 0).select(F.col("o_orderkey").cast("string").alias("transcript_id"), F.lit("special").alias("meeting_type"))
    return warehouse.transcripts_typed(tr, maps, overrides).select("transcript_id", "meeting_type")


def signal_types(spark, d):
    """Multi-signal type from title, opening text, time and metadata label."""
    o = table(spark, d, "orders")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    title = F.when(pr == "1-URGENT", "CITY COUNCIL WORKSHOPS").when(pr == "2-HIGH", "CITY COUNCIL").when(pr == "3-MEDIUM", "")
    text = F.when(st == "F", "WELCOME TO THE CRA MEETING TODAY").when(st == "O", "GOOD MORNING").otherwise("SPECIAL SESSION")
    segments = F.array(F.struct(F.lit("9:00:00AM").alias("timestamp"), F.lit("CHAIR").alias("speaker"), text.alias("text")))
    time = F.when(F.col("o_custkey") % 2 == 0, "5:01 P.M.").otherwise("9:00 A.M.")
    label = rules.metadata_type(F.when(F.col("o_custkey") % 3 == 0, "Council Evening"))
    return o.select(
        F.col("o_orderkey").alias("meeting_id"), rules.detect_type(title, rules.opening_text(segments), time, label).alias("label")
    )


def keyword_types(spark, d):
    """Keyword classifiers in both orders, search terms and page labels."""
    o = table(spark, d, "orders")
    pr = F.col("o_orderpriority")
    title = (
        F.when(pr == "1-URGENT", "Evening CRA meeting").when(pr == "2-HIGH", "Special Workshop")
        .when(pr == "3-MEDIUM", "Community Redevelopment special").when(pr == "5-LOW", "Evening session").otherwise("Budget hearing")
    )
    command = F.when(pr == "1-URGENT", "CRA").when(pr == "2-HIGH", "Workshop").otherwise(pr)
    return o.select(
        F.col("o_orderkey").alias("meeting_id"),
        rules.by_keyword(title).alias("by_index"),
        rules.by_keyword(title, rules.LIST_ROW_KEYWORDS).alias("by_list"),
        rules.search_term(command).alias("search_term"),
        rules.page_label(F.lit(None).cast("string"), title).alias("page_label"),
    )


def _index(spark, d):
    """customers of an index of published transcripts: pkey, date, type."""
    return _transcripts(spark, d).select(F.col("transcript_id").alias("pkey"), "date", "meeting_type")


def _with_source(spark, d):
    a = _agendas(spark, d)
    return a.withColumn("transcript_source_id", F.when(F.col("o_custkey") % 2 == 0, F.col("id").cast("string")))


def index_match(spark, d):
    out = discover.match_index(_index(spark, d), _with_source(spark, d))
    return out.select("pkey", "agenda_id", F.col("already_matched").cast("int").alias("already_matched"))


def _todo(spark, d):
    matched = discover.match_index(_index(spark, d), _with_source(spark, d))
    done = _index(spark, d).where(F.col("pkey").cast("bigint") % 3 == 0).select("pkey")
    return matched, discover.unprocessed(matched, done, "pkey")


def unprocessed(spark, d):
    return _todo(spark, d)[1].select("pkey", "agenda_id", F.col("processable").cast("int").alias("processable"))


def discovery_health(spark, d):
    matched, todo = _todo(spark, d)
    return discover.health(matched, todo)


IX_SQL = M_SQL + """,
a AS (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN CAST(id AS VARCHAR) END AS src FROM m WHERE o_orderstatus <> 'P'),
best AS (SELECT date, meeting_type, arg_max(id, (item_count, -id)) AS agenda_id FROM a GROUP BY 1, 2),
ix AS (SELECT CAST(t.id AS VARCHAR) AS pkey, b.agenda_id, a.src IS NOT NULL AS done
       FROM m t LEFT JOIN best b USING (date, meeting_type) LEFT JOIN a ON a.id = b.agenda_id WHERE t.o_orderstatus = 'P'),
todo AS (SELECT pkey, agenda_id, agenda_id IS NOT NULL AS processable FROM ix WHERE NOT done AND CAST(pkey AS BIGINT) % 3 <> 0)
"""


def ids_between(spark, d):
    return discover.ids_between(raw_table(spark, d, "orders"), "o_orderdate", "1996-01-01", "1997-01-01", "o_custkey")


def year_filter(spark, d):
    """Meetings of one year, as a range on the stored column: the scan gets the filter."""
    o = raw_table(spark, d, "orders")
    year = o.where((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return year.groupBy(F.col("o_orderpriority").alias("meeting_type")).agg(F.count(F.lit(1)).alias("meetings"))


def has_content(spark, d):
    """Meetings with items or a transcript since a cutoff date."""
    m = _with_source(spark, d)
    out = m.where((F.col("date") >= F.lit("1998-01-01").cast("date")) & ((F.col("item_count") > 0) | F.col("transcript_source_id").isNotNull()))
    return out.select("id", "item_count")


def falsy_defaults(spark, d):
    """0 and '' count as missing; title default chain."""
    p = table(spark, d, "part")
    title = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.col("p_name"))
    text = F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))
    return p.select(
        "p_partkey",
        zero_to_null(F.col("p_size") % 4).alias("number"),
        default_title(title, text).alias("title"),
        first_present(title, text).alias("raw_title"),
        F.coalesce(blank_to_null(title), F.lit("none")).alias("filled"),
    )


def listing(spark, d):
    """Read-model listing; lines shipped by an even supplier stand for videos."""
    m = _with_source(spark, d)
    v = table(spark, d, "lineitem").where(F.col("l_suppkey") % 2 == 0).select(
        F.col("l_orderkey").alias("meeting_id"), F.col("l_partkey").cast("string").alias("video_id"), F.col("l_linenumber").alias("part")
    )
    return readmodel.listing(m, v, "1996-01-01").select("id", "date", "meeting_type", "item_count", "has_video", "first_video_id")


def nested_items(spark, d):
    """Items as ordered arrays per meeting, shown as text."""
    pages = readmodel.nest_pages(_placed_lines(spark, d), ["l_orderkey"], "pos", ["l_linenumber", "l_partkey", "l_suppkey"], "items")
    shown = F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"], x["l_suppkey"])), ",")
    return pages.select(F.col("l_orderkey").alias("meeting_id"), "page", shown.alias("items"))


def nested_documents(spark, d):
    """customer → orders → lines as a two-level nested model."""
    o, li = table(spark, d, "orders"), _placed_lines(spark, d)
    items = o.select(F.col("o_custkey").alias("meeting_id"), F.col("o_orderkey").alias("item_pos"), F.lit(1).alias("item_number"), F.col("o_orderstatus").alias("file_number"), F.col("o_orderpriority").alias("title"))
    docs = li.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("meeting_id"), F.col("l_orderkey").alias("item_pos"), F.col("pos").alias("doc_pos"),
        F.concat_ws(":", "l_linenumber", "l_partkey").alias("title"), F.col("l_suppkey").cast("string").alias("source_url"),
    )
    nested = readmodel.items_with_documents(items, docs)
    flat = nested.select("meeting_id", F.explode("items").alias("i"))
    return flat.select(
        "meeting_id", F.col("i.item_pos").alias("item_pos"), F.col("i.title").alias("title"),
        F.array_join(F.transform("i.documents", lambda x: F.concat_ws(":", x["title"], x["source_url"])), ",").alias("documents"),
    )


def videos_with_chapters(spark, d):
    """conversations: conversation = meeting, role = video, turn = chapter."""
    c = table(spark, d, "conversations")
    videos = c.groupBy(F.col("conv_id").alias("meeting_id"), F.col("role").alias("video_id")).agg(F.min("turn").cast("int").alias("part")).withColumn("title", F.col("video_id"))
    chapters = c.select(F.col("conv_id").alias("meeting_id"), F.col("role").alias("video_id"), F.col("turn").cast("int").alias("chapter_index"), F.col("role").alias("title"), F.length("text").alias("seconds"))
    out = readmodel.videos_with_chapters(videos, chapters)
    one = lambda v: F.concat(v["video_id"], F.lit("["), F.array_join(F.transform(v["chapters"], lambda c: F.concat_ws(":", c["chapter_index"], c["seconds"])), " "), F.lit("]"))
    return out.select("meeting_id", F.array_join(F.transform("videos", one), ",").alias("videos"))


def transcript_baselines(spark, d):
    """Segments per conversation with the first one's text length as baseline."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("meeting_id"), F.col("turn").alias("segment_index"), F.md5("text").alias("timestamp"))
    return readmodel.baselines(c)


def unnested_segments(spark, d):
    """Segments nested into pages and unnested again with their running index."""
    c = table(spark, d, "conversations")
    pages = readmodel.segments_nested(
        c.select(F.col("conv_id").alias("meeting_id"), F.col("turn").alias("segment_index"), F.lit("").alias("timestamp"), F.col("role").alias("speaker"), "text")
    )
    rows = pages.select("meeting_id", F.posexplode("segments").alias("pos", "s"))
    return rows.select("meeting_id", F.col("s.segment_index").alias("segment_index"), F.col("s.speaker").alias("speaker"), F.md5(F.coalesce("s.text", F.lit(""))).alias("text_md5"))


def by_date(spark, d):
    """Date → meetings multimap, shown one row per entry."""
    m = meetings(spark, d).withColumn("title", F.col("o_orderstatus"))
    pages = readmodel.by_date(m)
    return pages.select("date", F.explode("meetings").alias("x")).select("date", "x.id", "x.meeting_type", "x.title")


def archive(spark, d):
    m = meetings(spark, d)
    out = readmodel.latest_and_archive(m)
    return out.groupBy("date", "date_rank", "is_latest").agg(F.count(F.lit(1)).alias("meetings"))


def combined_days(spark, d):
    m = meetings(spark, d).select(
        "date", "id", F.when(F.col("meeting_type") == "5-LOW", "evening").otherwise("regular").alias("meeting_type"),
        (F.col("o_orderstatus") == "P").alias("is_addendum"),
    )
    return readmodel.combined_days(m).select("date", "id", F.col("position").cast("bigint").alias("position"), "in_day", "is_multi")


def index_order(spark, d):
    """Index of meetings, newest first, those without a date last."""
    m = meetings(spark, d).withColumn("date", F.when(F.col("o_custkey") % 9 != 0, F.col("date")))
    return readmodel.index_order(m, "date", "id").select("id", "shown_date")


def orphan_lines(spark, d):
    """Foreign-key check: lines whose part the kept parts lack."""
    parts = table(spark, d, "part").where(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey"))
    return keyed.absent(table(spark, d, "lineitem"), parts, ["l_partkey"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("orphans"))


def metadata_lookup(spark, d):
    """Metadata by id and by date; the last order of a date wins."""
    o = table(spark, d, "orders")
    by_date_map = keyed.best_per_key(o.select("o_orderdate", "o_orderkey", "o_orderpriority"), ["o_orderdate"], [F.col("o_orderkey")])
    customers = o.select("o_custkey", "o_orderdate").groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return customers.join(by_date_map, "o_orderdate", "left").select("o_custkey", "o_orderkey", rules.metadata_type("o_orderpriority").alias("label"), F.col("o_orderpriority").alias("raw_label"))


def source_fallback(spark, d):
    """Per customer: shipped orders if any, else open ones, else the rest."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    pick = lambda s: keyed.best_per_key(o.where(F.col("o_orderstatus") == s), ["o_custkey"], [-F.col("o_orderkey")])
    return keyed.first_available([pick("P"), pick("F"), pick("O")], ["o_custkey"])


QUERIES = {
    "item_counts": (item_counts, "SELECT l_orderkey AS meeting_id, count(*) AS item_count FROM lineitem GROUP BY 1"),
    "keep_fullest": (
        keep_fullest,
        f"WITH {M_SQL} SELECT date, meeting_type, arg_max(id, (item_count, -id)) AS id, max(item_count) AS item_count FROM m GROUP BY 1, 2",
    ),
    "match_transcripts": (
        match_transcripts,
        f"WITH {AT_SQL} SELECT a.id, a.date, a.meeting_type, a.item_count, CAST(own.last_id AS VARCHAR) AS transcript_source_id FROM a JOIN own USING (id)",
    ),
    "transcript_stubs": (
        transcript_stubs,
        f"""WITH {AT_SQL} SELECT id, date, meeting_type, meeting_type || ' — ' || strftime(date, '%B %-d, %Y') AS title,
            CAST(0 AS BIGINT) AS item_count, CAST(last_id AS VARCHAR) AS transcript_source_id FROM own WHERE stub""",
    ),
    "superseded_transcripts": (
        superseded_transcripts,
        f"""WITH {AT_SQL} SELECT CAST(t.tid AS VARCHAR) AS transcript_id, own.id AS meeting_id, CAST(last_id AS VARCHAR) AS superseded_by
            FROM t JOIN own USING (date, meeting_type) WHERE t.tid <> own.last_id""",
    ),
    "matching_stats": (
        matching_stats,
        f"""WITH {AT_SQL} SELECT (SELECT count(*) FROM own WHERE NOT stub) AS matched, (SELECT count(*) FROM own WHERE stub) AS stubbed,
            (SELECT count(*) FROM t JOIN own USING (date, meeting_type) WHERE t.tid <> own.last_id) AS superseded""",
    ),
    "cascade_delete": (
        cascade_delete,
        f"""WITH {M_SQL}, k AS (SELECT arg_max(id, (item_count, -id)) AS id FROM m GROUP BY date, meeting_type)
            SELECT l_orderkey, count(*) AS items, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM lineitem WHERE l_orderkey IN (SELECT id FROM k) GROUP BY 1""",
    ),
    "newest_document": (
        newest_document,
        """WITH b AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY 1)
           SELECT o_custkey AS "meetingId", 'meeting_' || lpad(CAST(k AS VARCHAR), 10, '0') AS file_name, count(*) AS items
           FROM b JOIN lineitem ON l_orderkey = k GROUP BY ALL""",
    ),
    "infer_types": (
        infer_types,
        """SELECT l_orderkey AS meeting_id, CASE WHEN avg(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0 END) > 0.6 THEN 'cra'
                  WHEN avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0 END) > 0.6 THEN 'evening' ELSE 'regular' END AS meeting_type
           FROM lineitem GROUP BY 1""",
    ),
    "transcript_types": (
        transcript_types,
        """SELECT CAST(o_orderkey AS VARCHAR) AS transcript_id,
             CASE WHEN o_custkey % 11 = 0 THEN 'special'
                  WHEN o_custkey % 5 = 0 THEN CASE o_orderstatus WHEN 'F' THEN 'evening' WHEN 'O' THEN 'cra' ELSE 'regular' END
                  WHEN o_orderpriority = '1-URGENT' THEN 'workshop' WHEN o_orderpriority = '2-HIGH' THEN 'cra'
                  WHEN o_orderstatus = 'F' AND regexp_matches('5:01 P.M.', '5:0[01]\\s*P|[6-9]:\\d\\d\\s*P') THEN 'evening' ELSE 'regular' END AS meeting_type
           FROM orders""",
    ),
    "signal_types": (
        signal_types,
        """SELECT o_orderkey AS meeting_id,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'Workshop' WHEN o_orderstatus = 'F' THEN 'CRA'
                  WHEN o_orderstatus NOT IN ('F', 'O') THEN 'Special' WHEN o_custkey % 2 = 0 THEN 'Evening'
                  WHEN o_orderpriority = '2-HIGH' THEN 'City Council' WHEN o_custkey % 3 = 0 THEN 'Evening' ELSE 'City Council' END AS label
           FROM orders""",
    ),
    "keyword_types": (
        keyword_types,
        """SELECT o_orderkey AS meeting_id,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'cra' WHEN '2-HIGH' THEN 'workshop' WHEN '3-MEDIUM' THEN 'cra' WHEN '5-LOW' THEN 'evening' ELSE 'regular' END AS by_index,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'evening' WHEN '2-HIGH' THEN 'workshop' WHEN '3-MEDIUM' THEN 'special' WHEN '5-LOW' THEN 'evening' ELSE 'regular' END AS by_list,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'Community Redevelopment' WHEN '2-HIGH' THEN 'City Council' ELSE o_orderpriority END AS search_term,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'Community Redevelopment Agency Meeting' WHEN '2-HIGH' THEN 'City Council Workshop' WHEN '5-LOW' THEN 'City Council Evening Session' ELSE 'City Council Meeting' END AS page_label
           FROM orders""",
    ),
    "index_match": (index_match, f"WITH {IX_SQL} SELECT pkey, agenda_id, CAST(done AS INTEGER) AS already_matched FROM ix"),
    "unprocessed": (unprocessed, f"WITH {IX_SQL} SELECT pkey, agenda_id, CAST(processable AS INTEGER) AS processable FROM todo"),
    "discovery_health": (
        discovery_health,
        f"""WITH {IX_SQL} SELECT count(*) AS indexed, count(agenda_id) AS with_agenda, count(*) FILTER (done) AS done,
            (SELECT count(*) FROM todo) AS unprocessed, (SELECT count(*) FROM todo WHERE processable) AS processable FROM ix""",
    ),
    "ids_between": (ids_between, "SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'"),
    "year_filter": (year_filter, "SELECT o_orderpriority AS meeting_type, count(*) AS meetings FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1"),
    "has_content": (
        has_content,
        f"WITH {M_SQL} SELECT id, item_count FROM m WHERE o_orderstatus <> 'P' AND date >= DATE '1998-01-01' AND (item_count > 0 OR o_custkey % 2 = 0)",
    ),
    "falsy_defaults": (
        falsy_defaults,
        """WITH x AS (SELECT *, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN p_name END AS t, CASE WHEN p_size % 2 = 0 THEN p_brand END AS b FROM part)
           SELECT p_partkey, nullif(p_size % 4, 0) AS number, coalesce(nullif(t, ''), nullif(b, ''), 'Document') AS title,
                  coalesce(nullif(t, ''), nullif(b, '')) AS raw_title, coalesce(nullif(t, ''), 'none') AS filled FROM x""",
    ),
    "listing": (
        listing,
        f"""WITH {M_SQL}, v AS (SELECT l_orderkey AS id, arg_min(CAST(l_partkey AS VARCHAR), (l_linenumber, CAST(l_partkey AS VARCHAR))) AS fv FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1)
            SELECT id, date, meeting_type, item_count, CASE WHEN fv IS NULL THEN 0 ELSE 1 END AS has_video, fv AS first_video_id
            FROM m LEFT JOIN v USING (id) WHERE o_orderstatus <> 'P' AND date >= DATE '1996-01-01' AND (item_count > 0 OR o_custkey % 2 = 0)""",
    ),
    "nested_items": (
        nested_items,
        """SELECT l_orderkey AS meeting_id, CAST(0 AS BIGINT) AS page,
             string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY 1, 2""",
    ),
    "nested_documents": (
        nested_documents,
        """SELECT o_custkey AS meeting_id, o_orderkey AS item_pos, o_orderpriority AS title,
             string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS documents
           FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    ),
    "videos_with_chapters": (
        videos_with_chapters,
        """WITH c AS (SELECT conv_id, role, min(turn) AS part, string_agg(turn || ':' || length(text), ' ' ORDER BY turn) AS ch FROM conversations GROUP BY 1, 2)
           SELECT conv_id AS meeting_id, string_agg(role || '[' || ch || ']', ',' ORDER BY part, role) AS videos FROM c GROUP BY 1""",
    ),
    "transcript_baselines": (transcript_baselines, "SELECT conv_id AS meeting_id, arg_min(md5(text), turn) AS baseline FROM conversations GROUP BY 1"),
    "unnested_segments": (unnested_segments, "SELECT conv_id AS meeting_id, turn AS segment_index, role AS speaker, md5(coalesce(text, '')) AS text_md5 FROM conversations"),
    "by_date": (by_date, "SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, o_orderpriority AS meeting_type, o_orderstatus AS title FROM orders"),
    "archive": (
        archive,
        """SELECT CAST(o_orderdate AS DATE) AS date, dense_rank() OVER (ORDER BY CAST(o_orderdate AS DATE) DESC) AS date_rank,
             CASE WHEN dense_rank() OVER (ORDER BY CAST(o_orderdate AS DATE) DESC) = 1 THEN 1 ELSE 0 END AS is_latest, count(*) AS meetings FROM orders GROUP BY 1""",
    ),
    "combined_days": (
        combined_days,
        """SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey AS id,
             row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END, o_orderkey) AS position,
             count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE)) AS in_day,
             CASE WHEN count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE)) > 1 THEN 1 ELSE 0 END AS is_multi
           FROM orders WHERE o_orderstatus <> 'P'""",
    ),
    "index_order": (
        index_order,
        "SELECT o_orderkey AS id, CASE WHEN o_custkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '0000-00-00' END AS shown_date FROM orders",
    ),
    "orphan_lines": (orphan_lines, "SELECT l_returnflag, count(*) AS orphans FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1"),
    "metadata_lookup": (
        metadata_lookup,
        """WITH c AS (SELECT o_custkey, max(o_orderdate) AS dt FROM orders GROUP BY 1),
           b AS (SELECT o_orderdate AS dt, max(o_orderkey) AS k FROM orders GROUP BY 1)
           SELECT c.o_custkey, k AS o_orderkey, CAST(NULL AS VARCHAR) AS label, o_orderpriority AS raw_label
           FROM c JOIN b USING (dt) JOIN orders ON o_orderkey = k""",
    ),
    "source_fallback": (
        source_fallback,
        """WITH r AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o_orderkey) AS n FROM orders)
           SELECT o_custkey, o_orderkey, o_orderstatus FROM r WHERE n = 1""",
    ),
}
