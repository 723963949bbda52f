"""Plans give the same answer when every group counts as too large for a task."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators.nesting import nest_pages
from gavel.plans import finance, timeline
from gavel.queries.tables import event_segments

FOLDER = "/root/testdata/sf0.001"


def hot(spark):
    """events with a third of all rows under one meeting."""
    e = event_segments(spark, FOLDER)
    return e.withColumn("meeting_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("meeting_id"))).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_gaps(spark):
    seg = hot(spark)
    find = lambda n: timeline.detect_gaps(seg, "meeting_id", ["us", "event_id"], "clock", 60, seconds=F.col("sec"), wrap=False, target_rows=n)
    cols = ["meeting_id", "gap_no", "end_timestamp", "resume_timestamp", "gap_minutes"]
    cut = rows(find(40).select(*cols))
    assert len(cut) > 100 and cut == rows(find(10**6).select(*cols))


def test_video_positions(spark):
    seg = hot(spark)
    videos = seg.where("event_type = 'purchase'").select("meeting_id", F.col("sec").alias("start_sec"), F.col("event_id").alias("part"), F.lit(3).alias("offset_seconds"))
    said = seg.where("event_type = 'error'").select("meeting_id", "event_id", "sec")
    place = lambda n: timeline.video_positions(said, videos, "meeting_id", "sec", "start_sec", target_rows=n).select("meeting_id", "event_id", "video_part", "video_seconds")
    assert rows(place(15)) == rows(place(10**6))


def test_pages_are_bounded_and_whole(spark):
    rows_in = spark.range(0, 2500).select(F.lit(1).alias("m"), F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    pages = nest_pages(rows_in, ["m"], "pos", ["v"], "xs", page_rows=100)
    assert pages.agg(F.max(F.size("xs"))).first()[0] == 100
    assert rows(pages.select(F.explode("xs").alias("x")).select("x.pos", "x.v")) == rows(rows_in.select("pos", "v"))


def test_settled_type_equals_a_fold(spark):
    """The aggregate form against the step-by-step rule on every order of four mentions."""
    import itertools

    kinds = [
        ("unspecified", "plain"), ("expenditure", "payment"), ("revenue", "grant revenue"), ("revenue", "revenue (expenditure)"),
        ("expenditure_decrease", "expenditure decrease"), ("expenditure_decrease", "budget decrease"), ("expenditure_decrease", "credit (expenditure)"),
    ]

    def fold(seq):
        state = None
        for kind, text in seq:
            if state in (None, "unspecified"):
                state = kind
            elif state != kind:
                if "expenditure decrease" in text:
                    state = "expenditure_decrease"
                elif ("(expenditure)" in text or kind == "expenditure") and "decrease" not in text:
                    state = "expenditure"
        return state

    data, want = [], {}
    for i, seq in enumerate(itertools.product(kinds, repeat=4)):
        want[i] = fold(seq)
        data += [(i, 0, j, 0, "$1", 1.0, k, None, t, "s") for j, (k, t) in enumerate(seq)]
    df = spark.createDataFrame(data, "item int, source_rank int, line_no int, amount_no int, amount string, value double, type string, section string, context string, source string")
    got = {r["item"]: r["type"] for r in finance.consolidate(df, ["item"]).collect()}
    assert got == want
