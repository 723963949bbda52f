"""The six warehouse tables from meeting, transcript and video documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.base import blank_to_null, first_present, zero_to_null
from ..functions.dates import iso_duration_seconds, resolve_date, wall_clock_seconds
from ..functions.text import default_title
from ..operators.keyed import absent, best_per_key, insert_if_absent, keep_referenced
from ..session import stored


def stub_id(transcript_id: str):
    """Id of the stub meeting that a transcript gets: below zero, where no real id is."""
    return -F.col(transcript_id) - 1


def latest_documents(meetings: DataFrame) -> DataFrame:
    """One document per meeting id: the last file in name order replaces earlier ones."""
    return best_per_key(meetings, ["meetingId"], [F.col("file_name")])


def dated(meetings: DataFrame, year: int | None = None) -> DataFrame:
    """Meetings with a resolved date; rows without one are left out."""
    df = meetings.withColumn("date", resolve_date("formattedDate", "meetingDate", "file_name"))
    df = df.where(F.col("date").isNotNull())
    return df.where(F.year("date") == year) if year else df


def items_of(meetings: DataFrame) -> DataFrame:
    """Items with their position; a meeting without items keeps no item row."""
    rows = meetings.select(
        F.col("meetingId").try_cast("bigint").alias("meeting_id"),
        F.year("date").alias("year"),
        F.posexplode("agendaItems").alias("item_pos", "item"),
    )
    return rows.select("meeting_id", "year", "item_pos", "item.*")


def infer_types(items: DataFrame) -> DataFrame:
    """Meeting type from the mix of file-number prefixes."""
    prefix = rules.file_number_prefix("fileNumber")
    counts = items.groupBy("meeting_id").agg(
        F.count(F.when(prefix == "CRA", 1)).alias("cra"),
        F.count(F.when(prefix.isin(*rules.EVENING_PREFIXES), 1)).alias("evening"),
        F.count(prefix).alias("total"),
    )
    return counts.select("meeting_id", rules.type_from_prefix_counts("cra", "evening", "total").alias("meeting_type"))


def item_rows(items: DataFrame) -> DataFrame:
    t = "financialTotals"
    money = lambda c: F.coalesce(F.col(f"{t}.{c}"), F.lit(0.0)).cast("decimal(18,2)")
    return items.select(
        "meeting_id",
        "item_pos",
        zero_to_null("number").alias("item_number"),
        blank_to_null("agendaItemId").alias("agenda_item_id"),
        blank_to_null("fileNumber").alias("file_number"),
        first_present("title", "rawTitle").alias("title"),
        blank_to_null("background").alias("background"),
        blank_to_null("location").alias("location"),
        "coordinates",
        F.when(F.size("dollarAmounts") > 0, F.col("dollarAmounts")).alias("dollar_amounts"),
        money("expenditures").alias("fiscal_expenditures"),
        money("revenues").alias("fiscal_revenues"),
        money("net").alias("fiscal_net"),
        "year",
    )


def document_rows(items: DataFrame) -> DataFrame:
    docs = items.select("meeting_id", "item_pos", "year", F.posexplode("supportingDocuments").alias("doc_pos", "d"))
    return docs.select(
        "meeting_id",
        "item_pos",
        "doc_pos",
        default_title("d.title", "d.originalText").alias("title"),
        blank_to_null("d.url").alias("source_url"),
        blank_to_null("d.mirroredUrl").alias("mirrored_url"),
        blank_to_null("d.originalText").alias("original_text"),
        "year",
    )


def keep_fullest(meetings: DataFrame) -> DataFrame:
    """One meeting per (date, type): most items, then lowest id."""
    return best_per_key(meetings, ["date", "meeting_type"], [F.col("item_count"), -F.col("id")])


def transcripts_typed(transcripts: DataFrame, video_maps: DataFrame, overrides: DataFrame) -> DataFrame:
    """Transcripts with a meeting type from override, video listing, title or time."""
    v = video_maps.select(F.col("meeting_id").cast("string").alias("transcript_id"), F.col("meeting_type").alias("_vt"))
    v = best_per_key(v, ["transcript_id"], [F.coalesce(F.col("_vt"), F.lit(""))])
    o = overrides.select("transcript_id", F.col("meeting_type").alias("_ov"))
    df = transcripts.join(v, "transcript_id", "left").join(o, "transcript_id", "left")
    return df.withColumn(
        "meeting_type", rules.transcript_type("_ov", "_vt", "meeting_title", "meeting_date_time")
    ).drop("_vt", "_ov")


def match_transcripts(meetings: DataFrame, transcripts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(meetings with their transcript, transcript→meeting links, superseded transcripts).

    meetings: id, date, meeting_type, item_count, ...; transcripts: transcript_id
    (numeric text), date, meeting_type.  Per (date, type) the fullest meeting takes
    the transcript with the highest id.  Where no meeting exists a stub is made from
    the lowest transcript id; its `is_stub` says so, and its id is negative, so it
    cannot meet a real one.  Transcripts that lost out are reported, not dropped.
    """
    tid = F.col("transcript_id").cast("bigint")
    groups = transcripts.groupBy("date", "meeting_type").agg(F.min(tid).alias("first_id"), F.max(tid).alias("last_id"))
    best = meetings.groupBy("date", "meeting_type").agg(
        F.max_by("id", F.struct(F.col("item_count"), -F.col("id"))).alias("id")
    )
    owned = groups.join(best, ["date", "meeting_type"], "left").withColumn("is_stub", F.col("id").isNull())
    owned = owned.withColumn("id", F.coalesce("id", stub_id("first_id")))
    sources = owned.select("id", F.col("last_id").cast("string").alias("_source"))
    matched = meetings.join(sources, "id", "left")
    if "transcript_source_id" in meetings.columns:
        matched = matched.withColumn("transcript_source_id", F.coalesce("_source", "transcript_source_id"))
    else:
        matched = matched.withColumn("transcript_source_id", F.col("_source"))
    matched = matched.drop("_source").withColumn("is_stub", F.lit(False))
    stubs = owned.where("is_stub").select(
        "id",
        "is_stub",
        "date",
        "meeting_type",
        rules.meeting_title("meeting_type", "date").alias("title"),
        F.lit(0).alias("item_count"),
        F.col("last_id").cast("string").alias("transcript_source_id"),
    )
    out = insert_if_absent(matched, stubs, ["id"])
    links = owned.select(F.col("last_id").cast("string").alias("transcript_id"), F.col("id").alias("meeting_id"), "is_stub")
    lost = transcripts.join(owned.select("date", "meeting_type", "last_id", "id"), ["date", "meeting_type"])
    lost = lost.where(tid != F.col("last_id")).select(
        "transcript_id", F.col("id").alias("meeting_id"), F.col("last_id").cast("string").alias("superseded_by")
    )
    return out, links, lost


def segment_rows(transcripts: DataFrame, links: DataFrame) -> DataFrame:
    rows = transcripts.select("transcript_id", "date", "segments").join(links.drop("is_stub"), "transcript_id").select(
        "meeting_id", F.year("date").alias("year"), F.posexplode("segments").alias("segment_index", "s")
    )
    return rows.select(
        "meeting_id",
        "segment_index",
        "s.timestamp",
        "s.speaker",
        F.coalesce("s.text", F.lit("")).alias("text"),
        wall_clock_seconds("s.timestamp").alias("sec_of_day"),
        "year",
    )


def video_rows(video_maps: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(videos, chapters)."""
    rows = (
        video_maps.withColumn("transcript_id", F.col("meeting_id").cast("string")).drop("meeting_id")
        .join(links, "transcript_id")
        .select("meeting_id", F.year(F.to_date("meeting_date")).alias("year"), F.explode("videos").alias("v"))
    )
    videos = rows.select(
        "meeting_id",
        "v.video_id",
        "v.title",
        F.coalesce("v.part", F.lit(1)).alias("part"),
        "v.session",
        F.try_to_timestamp("v.published_at").alias("published_at"),
        "v.duration",
        iso_duration_seconds("v.duration").alias("duration_sec"),
        F.coalesce(F.bround("v.offset_seconds", 0).cast("int"), F.lit(0)).alias("offset_seconds"),
        "v.transcript_start_time",
        "year",
    )
    chapters = rows.select(
        "meeting_id", F.col("v.video_id").alias("video_id"), F.posexplode("v.chapters").alias("chapter_index", "c"), "year"
    ).select("meeting_id", "video_id", "chapter_index", "c.title", "c.timestamp", "c.seconds", "year")
    return videos, chapters


def build(
    meetings: DataFrame, transcripts: DataFrame, video_maps: DataFrame, overrides: DataFrame, year: int | None = None
) -> dict[str, DataFrame]:
    """All tables; `year` filters agendas and transcripts alike.

    Several tables read the documents, the kept meetings, the transcripts and their links, so these are stored once:
    the source files are parsed and their rows shuffled one time, and each table reads only the columns it needs."""
    docs = stored(dated(latest_documents(meetings), year), "meeting-documents")
    items = items_of(docs)
    heads = docs.select(
        F.col("meetingId").try_cast("bigint").alias("id"),
        "date",
        F.col("agendaType").alias("agenda_type"),
        F.col("sourceUrl").alias("source_url"),
        F.greatest(F.coalesce(F.size("agendaItems"), F.lit(0)), F.lit(0)).alias("item_count"),
        F.year("date").alias("year"),
    )
    typed = heads.join(infer_types(items).withColumnRenamed("meeting_id", "id"), "id", "left").withColumn(
        "meeting_type", F.coalesce("meeting_type", F.lit("regular"))
    )
    typed = typed.withColumn("title", rules.meeting_title("meeting_type", "date"))
    kept = stored(keep_fullest(typed), "kept-meetings")
    tr = transcripts.where(F.year("date") == year) if year else transcripts
    tr = stored(transcripts_typed(tr, video_maps, overrides), "transcripts")
    full, links, lost = match_transcripts(kept, tr)
    links = stored(links, "transcript-links")
    full = full.withColumn("year", F.coalesce("year", F.year("date")))
    keep = kept.select(F.col("id").alias("meeting_id"))
    videos, chapters = video_rows(video_maps, links)
    return {
        "meetings": full,
        "agenda_items": keep_referenced(item_rows(items), keep, ["meeting_id"]),
        "documents": keep_referenced(document_rows(items), keep, ["meeting_id"]),
        "transcript_segments": segment_rows(tr, links),
        "videos": videos,
        "video_chapters": chapters,
        "superseded_transcripts": lost,
    }


def write(tables: dict[str, DataFrame], path: str) -> None:
    """Full refresh, one folder per table, partitioned by year where there is one."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if "year" in df.columns:
            writer = writer.partitionBy("year")
        writer.parquet(f"{path}/{name}")


def write_counted(tables: dict[str, DataFrame], path: str, metrics: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """`write`, and what was written: (table, metric, value), counted while the rows go by.

    Every table has `rows`; `metrics` names more sums or counts of a table, as aggregate columns that give whole numbers.
    No table is read again.  Where an executor is lost and a finished task runs again, its rows count again."""
    seen = {name: Observation() for name in tables}
    observed = {}
    for name, df in tables.items():
        own = [m.cast("long").alias(k) for k, m in (metrics or {}).get(name, {}).items()]
        observed[name] = df.observe(seen[name], F.count(F.lit(1)).alias("rows"), *own)
    write(observed, path)
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, k, v) for name, o in seen.items() for k, v in o.get.items()]
    return spark.createDataFrame(rows, "table string, metric string, value long")


def run_stats(meetings: DataFrame, links: DataFrame, lost: DataFrame) -> DataFrame:
    """matched / stubbed / superseded counts as one row."""
    kind = F.when(F.col("is_stub"), "stubbed").otherwise("matched")
    known = links.join(meetings.select(F.col("id").alias("meeting_id")), "meeting_id", "left_semi").select(kind.alias("kind"))
    every = known.unionByName(lost.select(F.lit("superseded").alias("kind")))
    return every.agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in ("matched", "stubbed", "superseded")])


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Foreign-key check: child rows without a meeting, counted per table."""
    parents = tables["meetings"].select(F.col("id").alias("meeting_id"))
    parts = [
        absent(tables[t], parents, ["meeting_id"]).agg(F.count(F.lit(1)).alias("orphans")).withColumn("table", F.lit(t))
        for t in ("agenda_items", "documents", "transcript_segments", "videos", "video_chapters")
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
