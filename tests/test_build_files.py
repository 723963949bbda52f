"""The files of the warehouse build are bounded."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.queries import build
from gavel.sources import files

FOLDER = "/root/testdata/sf0.001"


def test_files_hold_a_bounded_number_of_meetings(spark, monkeypatch):
    monkeypatch.setattr(build, "BUNDLE", 2, raising=False)
    folder = build._folder(spark, FOLDER)
    for rows in (files.meetings(spark, folder, strict_name=True), files.video_maps(spark, folder).withColumn("file_name", F.input_file_name())):
        sizes = [r["count"] for r in rows.groupBy("file_name").count().collect()]
        assert sizes and max(sizes) <= 2


def test_tables_of_a_build_do_not_read_the_files_again(spark):
    built = build._built(spark, FOLDER)
    for name in ("meetings", "agenda_items", "documents", "transcript_segments"):
        plan = built[name]._jdf.queryExecution().executedPlan().toString()
        assert "Format: JSON" not in plan and "Scan json" not in plan and "InMemoryTableScan" not in plan, name


def test_written_files_are_counted_and_whole(spark, tmp_path):
    rows = [(f"f{k}.txt", None if k == 0 else "é" * k) for k in range(50)]
    assert files.write_files(spark.createDataFrame(rows, "name string, content string"), str(tmp_path / "out")) == 50
    assert all((tmp_path / "out" / n).read_text(encoding="utf-8") == (c or "") for n, c in rows)
