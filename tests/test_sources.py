"""File readers and the warehouse from small JSON files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gavel.plans import coverage, readmodel, timeline, warehouse
from gavel.sources import files, html
from gavel.streaming import incremental


def put(folder, name, content):
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    f = tmp_path_factory.mktemp("records")
    doc = {"title": "", "url": "/d", "originalText": "Sheet"}
    item = lambda fn, **kw: {"number": 1, "title": f"File No. {fn}", "fileNumber": fn, "supportingDocuments": [doc], "dollarAmounts": ["$5"], "financialTotals": {"expenditures": 5, "revenues": 0, "net": 5}, **kw}
    put(f, "meeting_10_2025-01-02.json", {"meetingId": "10", "meetingDate": "January 2, 2025", "agendaItems": [item("PS25-1"), item("CM25-2")]})
    put(f, "meeting_10_2025-01-03.json", {"meetingId": "10", "formattedDate": "2025-01-02", "agendaItems": [item("PS25-1"), item("CM25-2"), item("E25-3", number=0)]})
    put(f, "meeting_11_2025-01-02.json", {"meetingId": 11, "agendaItems": [item("PS25-9")]})
    put(f, "meeting_12_2025-02-02.json", {"meetingId": "12", "formattedDate": "2025-02-02", "agendaItems": [item("CRA-1"), item("CRA-2")]})
    put(f, "meeting_13_2025-03-02_old.json", {"meetingId": "13"})
    put(f, "meeting_14_2024-03-02.json", {"meetingId": "14", "agendaItems": []})
    put(f, "meeting_15_2025-04-02.json", "{ broken")
    seg = lambda *ts: [{"timestamp": t, "speaker": "CHAIR", "text": "HELLO"} for t in ts]
    put(f, "processed_transcript_100_2025-01-02.json", {"meeting_id": "100", "meeting_title": "CITY COUNCIL", "segments": seg("9:00:00AM", "9:30:00AM", "1:00:00PM")})
    put(f, "processed_transcript_101_2025-01-02.json", {"meeting_id": "101", "segments": seg("9:00:00AM")})
    put(f, "processed_transcript_102_2025-05-05.json", {"meeting_id": "102", "meeting_title": "WORKSHOPS", "transcript": seg("9:00:00AM")})
    put(f, "transcript_100_2025-01-02.json", {"segments": seg("9:00:00AM")})
    put(f, "transcript_103_2025-01-02.json", {"segments": seg("9:00:00AM")})
    put(f, "transcript_--transcript-id_2025-01-02.json", {"segments": seg("9:00:00AM")})
    put(f, "video_mapping_100.json", {"meeting_id": 100, "meeting_date": "2025-01-02", "videos": [
        {"video_id": "a", "title": "x", "part": 1, "duration": "PT1H", "offset_seconds": 12.5, "chapters": [{"title": "c", "timestamp": "0:00", "seconds": 0}]},
        {"video_id": "b", "title": "y", "part": 2}]})
    put(f, "video_mapping_bad.json", {"meeting_date": "2025-01-02"})
    put(f, "list_1.json", seg("9:00:00AM"))
    return f


@pytest.fixture(scope="module")
def tables(spark, folder):
    good, bad = files.split_corrupt(files.meetings(spark, str(folder)).cache())
    assert [r["file_name"] for r in bad.collect()] == ["meeting_15_2025-04-02.json"]
    processed = files.processed_transcripts(spark, str(folder)).drop("_corrupt_record")
    none = spark.createDataFrame([], "transcript_id string, meeting_type string")
    return warehouse.build(good, processed, files.video_maps(spark, str(folder)), none)


def test_scans(spark, folder):
    p = str(folder)
    assert files.meetings(spark, p).count() == 6
    assert files.meetings(spark, p, strict_name=True).count() == 6
    assert files.meetings_on(files.meetings(spark, p), "2025-01-02").count() == 2
    assert files.meeting_by_id(files.meetings(spark, p), "10").first()["file_name"] == "meeting_10_2025-01-02.json"
    raw = files.raw_transcripts(spark, p)
    assert sorted(r["transcript_id"] for r in raw.collect()) == ["100", "103"]
    assert files.raw_transcripts(spark, p, 2024).count() == 0
    both = files.preferred_transcripts(files.processed_transcripts(spark, p), raw)
    got = {r["transcript_id"]: r["file_name"].split("_")[0] for r in both.collect()}
    assert got == {"100": "processed", "101": "processed", "102": "processed", "103": "transcript"}
    assert files.video_maps(spark, p).count() == 1
    assert files.bare_list_transcripts(spark, p, "list_*.json").select(F.size("segments")).first()[0] == 1
    meta = files.meeting_metadata(files.meetings(spark, p).where("_corrupt_record is null").cache())
    assert {r["meetingId"]: r["agendaItemCount"] for r in meta.collect()}["12"] == 2
    cov = coverage.coverage(meta.withColumn("d", F.to_date("date")), "d", "meetingType")
    assert cov.where("level = 3").first()["meetings"] == 5


def test_lists(spark, tmp_path):
    put(tmp_path, "a.json", {"entities": {"states": ["Ohio", "Utah"], "days": ["Monday"]}, "all_entities": []})
    put(tmp_path, "db.json", {"people": {"Ann Lee": {"frequency": 2, "confidence": 0.9, "score": 1.8, "agendas": 2}}, "organizations": {}})
    put(tmp_path, "config.json", {"acronyms": ["ada"], "neighborhoods": ["hyde park"], "street_suffixes": ["st"], "skip_words": []})
    (tmp_path / "c.csv").write_text("official_name_en,CLDR display name\nPlurinational State of X,X\n,Y\n")
    names = files.entity_lists(spark, [str(tmp_path / "a.json"), str(tmp_path / "missing.json")])
    assert names.groupBy("category").count().count() == 2 and names.count() == 3
    assert files.entity_db(spark, str(tmp_path / "db.json")).first()["name"] == "Ann Lee"
    assert files.casing_config(spark, str(tmp_path / "config.json")).count() == 3
    assert {r["name"] for r in files.country_names(spark, str(tmp_path / "c.csv")).collect()} == {"Plurinational State of X", "X", "Y"}
    assert files.files_with_bytes(spark, str(tmp_path), "*.csv").count() == 1


def test_warehouse(tables):
    m = {r["id"]: r for r in tables["meetings"].collect()}
    # 11 lost to 10 (same date and type, fewer items); -103 is a stub
    assert set(m) == {10, 12, 14, -103}
    assert m[10]["item_count"] == 3 and m[10]["transcript_source_id"] == "101"
    assert m[12]["meeting_type"] == "cra" and m[-103]["meeting_type"] == "workshop"
    assert m[-103]["title"] == "Workshop — May 5, 2025"
    assert [tuple(r) for r in tables["superseded_transcripts"].collect()] == [("100", 10, "101")]
    items = tables["agenda_items"].where("meeting_id = 10").orderBy("item_pos").collect()
    assert [r["item_number"] for r in items] == [1, 1, None] and float(items[0]["fiscal_net"]) == 5.0
    assert tables["documents"].first()["title"] == "Sheet"
    assert tables["agenda_items"].where("meeting_id = 11").count() == 0
    assert sum(r["orphans"] for r in warehouse.orphans(tables).collect()) == 0


def test_year_filter_covers_transcripts(spark, folder):
    good, _ = files.split_corrupt(files.meetings(spark, str(folder)).cache())
    none = spark.createDataFrame([], "transcript_id string, meeting_type string")
    t = warehouse.build(good, files.processed_transcripts(spark, str(folder)), files.video_maps(spark, str(folder)), none, year=2024)
    assert [r["id"] for r in t["meetings"].collect()] == [14]


def test_dedupe_is_idempotent(tables):
    m = tables["meetings"].select("id", "date", "meeting_type", "item_count")
    once = warehouse.keep_fullest(m)
    assert once.exceptAll(warehouse.keep_fullest(once)).count() == 0


def test_write_and_listing(spark, tables, tmp_path):
    warehouse.write(tables, str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/meetings")
    assert back.where("year = 2025").count() == 3
    rows = readmodel.listing(back, spark.createDataFrame([(10, "v", 1)], "meeting_id long, video_id string, part int")).collect()
    assert [r["id"] for r in rows] == [-103, 12, 10] and rows[2]["has_video"] == 1


def test_part_starts_and_offsets(spark):
    seg = spark.createDataFrame([("m", i, c) for i, c in enumerate(["9:00:00AM", "11:00:00AM", "2:00:00PM"])], "meeting_id string, idx int, clock string")
    gaps = timeline.detect_gaps(seg, "meeting_id", "idx", "clock")
    videos = spark.createDataFrame([("m", 1, "a", None, 0.0), ("m", 2, "b", None, 0.0)], "meeting_id string, part int, video_id string, transcript_start_time string, offset_seconds double")
    filled, lost = timeline.save_part_starts(videos, gaps, "meeting_id")
    assert {r["part"]: r["transcript_start_time"] for r in filled.collect()} == {1: None, 2: "11:00:00AM"}
    assert [r["part"] for r in lost.collect()] == [3]
    off = spark.createDataFrame([("b", 2.5), ("zz", 1.0)], "video_id string, offset double")
    done, unknown = timeline.save_offsets(videos, off, ["video_id"])
    assert {r["video_id"]: r["offset_seconds"] for r in done.collect()} == {"a": 0, "b": 2}
    assert [r["video_id"] for r in unknown.collect()] == ["zz"]


def test_late_final_supersedes_draft(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    schema = "date string, meeting_type string, id long, item_count long, year int"
    keep = incremental.supersede(out, ["date", "meeting_type"], [F.col("item_count"), -F.col("id")], "year")
    for i, rows in enumerate([[("2025-01-02", "regular", 1, 3, 2025), ("2024-01-02", "cra", 9, 1, 2024)], [("2025-01-02", "regular", 2, 8, 2025)]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(src))
        incremental.run_available(incremental.new_files(spark, str(src), schema), str(tmp_path / "state"), keep)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [2, 9]


def test_table_rows_nest_and_close_by_implication(spark):
    pages = [
        (1, "<table><tr><td>a<table><tr><td>in</td></tr></table><a href='x'>l</a></td><td>b</td></tr></table>"),
        (2, "<table><thead><tr><th>h</th></tr></thead><tr><td>1<td>2<tr><td>3</table>"),
        (3, "<table><tr><td>open"),
        (4, None),
    ]
    got = html.table_rows(spark.createDataFrame(pages, "id int, html string"), "id").collect()
    rows = sorted((r["id"], r["table_no"], r["row_no"], tuple(r["cells"]), len(r["links"])) for r in got)
    assert rows == [
        (1, 0, 0, ("ainl", "b"), 1), (1, 1, 0, ("in",), 0), (2, 0, -1, (), 0), (2, 0, 0, ("1", "2"), 0), (2, 0, 1, ("3",), 0), (3, 0, 0, ("open",), 0),
    ]


def test_batches_of_one_partition_all_stay(spark, tmp_path):
    for i, ids in enumerate(([1, 2], [3], [4, 5])):
        spark.createDataFrame([(x, "a") for x in ids], "id long, kind string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.new_files(spark, str(tmp_path / "in"), "id long, kind string", files_per_batch=1)
    incremental.run_available(stream, str(tmp_path / "state"), incremental.append_partitions(str(tmp_path / "out"), "kind", lambda b: b))
    assert {r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1, 2, 3, 4, 5}
