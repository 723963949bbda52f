"""Plain pages are read without the slow parser, with the same rows; equal reports are read once."""

from __future__ import annotations

import random

from gavel.queries.text import zoning_facts
from gavel.sources import html

PARTS = [
    "<table>", '<TABLE border="1">', "</table>", "<tr>", '<tr data-meeting-id="7">', "<tr DATA-meeting-id='a&amp;b'>", "</tr>", "<td>", "</td>", "<th>", "<thead>",
    "</thead>", "<tbody>", '<a href="/x?a=1&amp;b=2" id="q">', "<a id href='l'>", "<a href>", "</a>", '<a href="q"/>', "<br/>", "text", " a &amp; b ", "&#39;", "&nbsp;", "\n",
    # not plain: read by the parser
    "<td class=x>", '<a href="/x?a=1&copy=2">', "&copy;x", "<!-- a - b -->", "<!DOCTYPE html>", "a<b", '<script>if(a<b)"<td>"</script>', "<title>t<td></title>", "</td >", "<b",
]


def parsed(page):
    parser = html._Tables()
    parser.feed(page)
    parser.close()
    return parser.rows


def test_same_rows_as_the_parser():
    rng = random.Random(5)
    for n in range(4000):
        page = "".join(rng.choice(PARTS if n % 3 == 0 else PARTS[:24]) for _ in range(rng.randrange(1, 16)))
        assert html.page_rows(page) == parsed(page), page


def test_plain_pages_do_not_reach_the_parser(monkeypatch):
    page = '<table><tr data-meeting-id="3"><td>1.<td><a href="/s?id=3&amp;d=1" id="k">A &amp; B</a></table>'
    wanted = parsed(page)
    monkeypatch.setattr(html._Tables, "feed", lambda self, text: 1 / 0)
    assert html.page_rows(page) == wanted and wanted[0][4][0]["href"] == "/s?id=3&d=1"


def test_null_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<table><tr><td>x</table>")], "k int, html string")
    assert [(r["k"], r["cells"]) for r in html.table_rows(pages, "k").collect()] == [(3, ["x"])]


def test_equal_reports_are_brought_together_before_they_are_read(spark):
    plan = zoning_facts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # of the reports, and of what was read in them



def test_tasks_of_pages_do_not_grow_with_the_input(spark):
    from gavel.operators.layout import spread_rows

    assert spread_rows(spark.range(0, 10_000, 1, 2), 500).rdd.getNumPartitions() == 20
    assert spread_rows(spark.range(0, 10, 1, 2), 500).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
