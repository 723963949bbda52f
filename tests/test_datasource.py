"""The record file source: what is opened, what is set apart, and what a stream takes up."""

from __future__ import annotations

import datetime
import json
import os
import time

import pytest

from gavel import schemas
from gavel.sources import datasource, files
from gavel.sources.datasource import RecordReader, RecordStream
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringContains


def _meeting(i, date, n=1):
    return [{"meetingId": str(i), "formattedDate": date, "agendaType": "FINAL", "agendaItems": [{"number": k, "title": "é"} for k in range(n)]}]


@pytest.fixture()
def folder(tmp_path):
    for i in range(1, 9):
        date = f"202{i % 3}-0{i}-01"
        (tmp_path / f"meeting_{i}_{date}.json").write_text(json.dumps(_meeting(i, date, i) * 2))
    (tmp_path / "meeting_9_2021-05-05.json").write_text("{ broken")
    (tmp_path / "meeting_10_2021-06-06.json").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "meeting_11_2021-13-45.json").write_text("{}")
    (tmp_path / "meeting_12_2021-01-01.json").write_text("[]")
    (tmp_path / "meeting_1_2021-01-01_old.json").write_text("never opened")
    (tmp_path / "notes.txt").write_text("never opened")
    return str(tmp_path)


def test_filters_choose_files_before_any_is_opened(folder):
    reader = RecordReader(folder, "meeting")
    wanted = [EqualTo(("year",), 2021), In(("record_id",), ("1", "4", "9")), GreaterThan(("date",), datetime.date(2021, 1, 1))]
    other = StringContains(("value",), "x")
    assert list(reader.pushFilters([*wanted, other])) == [other]
    names = [f.name for p in reader.partitions() for f in p.files]
    assert names == ["meeting_4_2021-04-01.json", "meeting_9_2021-05-05.json"]
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 3


def test_spark_plans_only_the_chosen_files(spark, folder):
    rows = datasource.record_files(spark, folder, "meeting").where("record_id = '4' AND year = 2021")
    rows._jdf.queryExecution().executedPlan()  # files are chosen here
    for name in os.listdir(folder):  # any other file would fail the scan
        if "meeting_4_" not in name:
            os.remove(f"{folder}/{name}")
    assert [r["file_name"] for r in rows.collect()] == ["meeting_4_2021-04-01.json"] * 2


def test_broken_files_are_set_apart_and_good_ones_equal_the_scan(spark, folder):
    rows = datasource.record_files(spark, folder, "meeting")
    bad = {r["file_name"]: r["corrupt"] for r in datasource.quarantine(rows).collect()}
    assert bad.keys() == {"meeting_9_2021-05-05.json", "meeting_10_2021-06-06.json"} and bad["meeting_9_2021-05-05.json"] == "{ broken"
    body = [c.split()[0] for c in ("meetingId x", "formattedDate x", "agendaItems x")]
    schema = schemas.MEETING.removesuffix(", _corrupt_record string")
    mine = datasource.typed(rows, schema).where("meetingId IS NOT NULL").select("file_name", *body)
    good, _ = files.split_corrupt(files.meetings(spark, folder, strict_name=True))
    theirs = good.where("meetingId IS NOT NULL").select("file_name", *body)
    assert sorted(map(str, mine.collect())) == sorted(map(str, theirs.collect())) and mine.count() == 16
    assert rows.where(F.col("record_id") == "11").first()["date"] is None


def test_an_empty_folder_has_no_rows(spark, tmp_path):
    assert datasource.record_files(spark, str(tmp_path), "meeting").count() == 0
    assert datasource.record_files(spark, str(tmp_path / "none"), "meeting").count() == 0


def test_stream_takes_each_file_once_over_restarts(spark, tmp_path):
    source, state, table = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "table")
    source.mkdir()

    def arrive(first, n):
        for i in range(first, first + n):
            (source / f"meeting_{i}_2024-01-01.json").write_text(json.dumps(_meeting(i, "2024-01-01")))
            time.sleep(0.01)

    def run():
        stream = datasource.record_stream(spark, str(source), "meeting", files_per_batch=2)
        query = stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", table).start()
        query.processAllAvailable()
        query.stop()

    arrive(1, 5)
    run()
    run()
    arrive(6, 2)
    run()
    got = spark.read.parquet(table)
    assert sorted(int(r["record_id"]) for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_offsets_follow_time_then_name(folder):
    stream = RecordStream(folder, "meeting", 3)
    seen, at = [], stream.initialOffset()
    while (end := stream.latestOffset()) != at:
        seen += [f.name for p in stream.partitions(at, end) for f in p.files]
        at = end
    assert len(seen) == len(set(seen)) == 12
