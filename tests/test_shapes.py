"""Records of any shape, counted writes, and SQL functions against their Column forms."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gavel.functions import dates, money, rules, sql, text, video
from gavel.plans import warehouse
from gavel.sources import files
from gavel.sources.html import table_rows

SEGMENTS = [{"timestamp": "9:00", "speaker": "A", "text": "é"}, {"text": None, "other": 1}]


@pytest.fixture()
def records(spark, tmp_path):
    shapes = {
        "a": SEGMENTS, "b": {"segments": SEGMENTS[:1]}, "c": {"transcript": SEGMENTS}, "d": {"segments": None, "transcript": SEGMENTS}, "e": {}, "f": [],
        "g": {"segments": "no list"}, "h": 7, "i": None, "s": {"net": 2.5}, "l": [{"value": 1}, {"value": 2.5}, {"x": 1}],
    }
    for name, value in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    (tmp_path / "x.json").write_text("{ broken")
    (tmp_path / "y.json").write_text("")
    return files.mixed_records(spark, str(tmp_path))


def test_segments_of_any_shape(records):
    rows = records.select(F.substring("file_name", 1, 1).alias("f"), F.size(files.variant_segments(F.col("record"))).alias("n"), "corrupt").collect()
    assert {r["f"]: r["n"] for r in rows} == {"a": 2, "b": 1, "c": 2, "d": 2, "e": 0, "f": 0, "g": 0, "h": 0, "i": 0, "s": 0, "l": 3, "x": 0}
    assert {r["f"] for r in rows if r["corrupt"]} == {"x"}


def test_totals_and_schema(records):
    chosen = records.where("file_name IN ('s.json', 'l.json')")
    totals = chosen.select("file_name", files.variant_total(F.col("record")).alias("t")).collect()
    assert {r["file_name"]: r["t"] for r in totals} == {"s.json": 2.5, "l.json": 3.5}
    assert files.shapes_of(chosen).first()["schema"] == "VARIANT" and "segments" in files.shapes_of(records.where("file_name = 'b.json'")).first()["schema"]


def test_counted_writes(spark, tmp_path):
    m = spark.range(10).select("id", (F.col("id") % 2).alias("year"))
    empty = m.where("false")
    stats = warehouse.write_counted({"m": m, "none": empty}, str(tmp_path), {"m": {"odd": F.count(F.when(F.col("year") == 1, 1)), "sum": F.sum("id")}})
    assert {tuple(r) for r in stats.collect()} == {("m", "rows", 10), ("m", "odd", 5), ("m", "sum", 45), ("none", "rows", 0)}
    assert spark.read.parquet(f"{tmp_path}/m").count() == 10


VALUES = [
    (1, "cra", "2024-02-03", "v1", "File No. A-1 \n Hi ", "x\n0:00 A b\n 1:02:03 Late \n5 no\n1:2:3:4 odd", "it is $1,234.50, $7 and $5 million"),
    (2, "other", None, " ", "  ", "", "no money"),
    (3, None, "1999-12-31", None, None, None, None),
]


def test_sql_functions_equal_the_column_functions(spark):
    sql.register(spark)
    sql.register(spark)
    v = spark.createDataFrame(VALUES, "id int, slug string, d string, video string, title string, chapters string, body string").withColumn("d", F.to_date("d"))
    v.createOrReplaceTempView("sql_function_values")
    got = spark.sql(
        "SELECT id, meeting_type_label(slug), readable_date(d), short_date(d), thumbnail_url(video), clean_title(title), has_content(title), watch_url(video, 5L) FROM sql_function_values"
    )
    want = v.select(
        "id", rules.type_label("slug"), dates.readable_date("d"), dates.short_date("d"), text.thumbnail_url("video"), text.clean_title("title"),
        text.has_content("title"), text.watch_url("video", F.lit(5)),
    )
    assert [tuple(r) for r in got.orderBy("id").collect()] == [tuple(r) for r in want.orderBy("id").collect()]
    chapters = spark.sql("SELECT id, c.title, c.clock, c.seconds FROM sql_function_values v, LATERAL chapters_in(v.chapters) c")
    columns = v.select("id", F.explode(video.chapters_of("chapters")).alias("c")).select("id", "c.title", "c.timestamp", "c.seconds")
    assert sorted(map(tuple, chapters.collect())) == sorted(map(tuple, columns.collect()))
    amounts = spark.sql("SELECT id, a.amount FROM sql_function_values v, LATERAL amounts_in(v.body) a")
    assert sorted(map(tuple, amounts.collect())) == sorted(map(tuple, v.select("id", F.explode(money.amounts_in("body"))).collect()))
    assert "Join" not in amounts._jdf.queryExecution().executedPlan().toString() and "Join" not in chapters._jdf.queryExecution().executedPlan().toString()


def test_html_rows_in_sql_equal_the_table_form(spark):
    sql.register(spark)
    pages = spark.createDataFrame([(1, "<table><tr><td>1.<td>x<tr><td>2.<td>y</table>"), (2, None), (3, "no table")], "id int, html string")
    pages.createOrReplaceTempView("sql_pages")
    got = spark.sql("SELECT id, r.table_no, r.row_no, r.cells FROM sql_pages p, LATERAL html_table_rows(p.html) r")
    want = table_rows(pages, "id").select("id", "table_no", "row_no", "cells")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2


def test_seek_in_videos(spark):
    sql.register(spark)
    call = "seek_in_videos({}, array(named_struct('part', 1, 'start_sec', 100L, 'offset_seconds', 2D), named_struct('part', 2, 'start_sec', 700L, 'offset_seconds', -50D)))"
    rows = spark.sql(f"SELECT {call.format('150L')}, {call.format('710L')}, {call.format('10L')}, {call.format('CAST(NULL AS BIGINT)')}").first()
    assert [r and (r["seconds"], r["part"]) for r in rows] == [(52.0, 1), (0.0, 2), (0.0, 1), None]
