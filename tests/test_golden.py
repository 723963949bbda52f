"""Known input/output pairs of single functions and small plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gavel.functions import boilerplate, dates, money, rules, text, urls, video
from gavel.plans import align, calendar, diff, finance, timeline, truecase, zoning
from gavel.sources import html, transcripts


def value(spark, column_of, *args):
    names = [f"a{i}" for i in range(len(args))]
    df = spark.createDataFrame([tuple(args)], ", ".join(f"{n} {'int' if isinstance(a, int) else 'string'}" for n, a in zip(names, args)))
    return df.select(column_of(*[F.col(n) for n in names]).alias("v")).first()["v"]


CLOCKS = [
    ("9:06:03AM", 32763), ("12:02:47PM", 43367), ("1:36:37PM", 48997), ("12:00:00AM", 0), ("12:00:00PM", 43200),
    ("5:01:00PM", 61260), ("09:15:50 AM", 33350), ("invalid", None), ("10:30", None), ("13:00:00PM", None),
]


@pytest.mark.parametrize("clock,seconds", CLOCKS)
def test_clock(spark, clock, seconds):
    assert value(spark, dates.wall_clock_seconds, clock) == seconds


@pytest.mark.parametrize("iso,seconds", [("PT3H7M21S", 11241), ("PT35M10S", 2110), ("PT3H41S", 10841), ("x", None)])
def test_iso_duration(spark, iso, seconds):
    assert value(spark, dates.iso_duration_seconds, iso) == seconds


def gaps(spark, clocks, threshold=60):
    rows = [("m", i, c) for i, c in enumerate(clocks)]
    df = spark.createDataFrame(rows, "meeting_id string, idx int, clock string")
    out = timeline.detect_gaps(df, "meeting_id", "idx", "clock", threshold).orderBy("gap_no").collect()
    return [(r["end_timestamp"], r["resume_timestamp"], r["gap_minutes"]) for r in out]


def test_gaps(spark):
    am = lambda *xs: [f"{x}:00AM" for x in xs]
    assert gaps(spark, am("9:00", "9:05", "9:15", "9:30", "9:45")) == []
    assert gaps(spark, am("9:00", "9:15", "9:30", "11:00", "11:15")) == [("9:30:00AM", "11:00:00AM", 90.0)]
    two = am("9:00", "9:15", "9:30", "11:45") + ["12:00:00PM", "5:01:00PM", "5:15:00PM"]
    assert [g[1] for g in gaps(spark, two)] == ["11:45:00AM", "5:01:00PM"]
    short = am("9:00", "9:10", "9:55", "10:05")
    assert gaps(spark, short) == [] and len(gaps(spark, short, 30)) == 1
    assert gaps(spark, am("9:00", "10:00")) == []  # exactly the threshold
    assert gaps(spark, ["9:00:00AM", "bad", "11:00:00AM"]) == [("bad", "11:00:00AM", 120.0)]
    assert gaps(spark, ["bad", "9:00:00AM", "11:00:00AM"]) == []
    assert gaps(spark, ["11:30:00PM", "1:00:00AM"]) == [("11:30:00PM", "1:00:00AM", 90.0)]  # past midnight


@pytest.mark.parametrize(
    "title,body,time,label",
    [
        ("CITY COUNCIL WORKSHOPS", "", "", "Workshop"),
        ("CITY COUNCIL", "WELCOME TO THE CRA MEETING TODAY", "", "CRA"),
        ("CITY COUNCIL", "", "5:01 P.M.", "Evening"),
        ("", "", "", "City Council"),
        ("CITY COUNCIL", "SPECIAL SESSION", "", "Special"),
    ],
)
def test_type(spark, title, body, time, label):
    assert value(spark, rules.detect_type, title, body, time) == label


def test_metadata_labels(spark):
    assert [value(spark, rules.metadata_type, x) for x in ("CRA Regular", "evening", "workshop", "gala")] == ["CRA", "Evening", "Workshop", None]


@pytest.mark.parametrize(
    "part,first,chapter,start,duration",
    [
        (1, 32400, None, 0, 600), (1, 33350, None, 950, 480), (2, None, 672, 552, 300), (2, None, None, 0, 900),
        (1, 48600, None, 0, 600), (1, None, None, 0, 600), (1, 32400, 690, 390, 480), (2, None, 60, 0, 600), (1, 61260, None, 0, 600),
    ],
)
def test_sampling_window(spark, part, first, chapter, start, duration):
    df = spark.createDataFrame([(part, first, chapter)], "p int, f int, c int")
    w = df.select(dates.sampling_window("p", "f", "c").alias("w")).first()["w"]
    assert (w["start"], w["duration"]) == (start, duration)


def test_money(spark):
    s = "cost $1234 and $9.4 million, $1,200 million"
    assert value(spark, lambda t: money.amounts_in(t, True), s) == ["$123", "$9.4 million", "$1,200"]
    assert value(spark, money.amounts_in, s) == ["$1234", "$9.4 million", "$1,200 million"]
    assert float(value(spark, money.amount_value, "$9.4 Million")) == 9.4e6
    assert value(spark, money.amount_label, "$9.4 million") == "$9,400,000.00"
    assert value(spark, money.entry_type, "revenue credit") == "expenditure_decrease"


def test_totals_equal_details(spark):
    items = spark.createDataFrame(
        [(1, "Fiscal Impact Statement:\npayment of $100.00\nProjected Costs\n$40.00 revenue", "Contract $100.00\nagain $7"), (2, None, "no money")],
        "item int, summary string, title string",
    )
    details = finance.from_item_texts(items, ["item"], [("summary", "summary"), ("title", "primary")])
    rows = {r["amount"]: r for r in details.collect()}
    assert rows["$100.00"]["type"] == "expenditure" and rows["$100.00"]["section"] == "fiscal_impact"
    assert rows["$40.00"]["type"] == "revenue" and rows["$7"]["type"] == "unspecified"
    assert rows["$100.00"]["sources"] == ["primary", "summary"]
    t = finance.item_totals(details, ["item"]).first()
    assert float(t["net"]) == sum(float(r["signed_value"]) for r in rows.values()) == 60.0
    f = finance.item_figures(details, ["item"]).first()
    assert (float(f["amount"]), float(f["expenditure"])) == (100.0, 100.0)


DICTIONARY = [
    ("cdbg", "CDBG", "acronym"), ("fdot", "FDOT", "acronym"), ("us", "US", "acronym"), ("it", "IT", "acronym"),
    ("street", "street", "suffix"), ("boulevard", "boulevard", "suffix"), ("grant", "grant", "skip"),
    ("spring heights", "Spring Heights", "entity"), ("velez", "Velez", "surname"), ("johnson", "Johnson", "surname"),
    ("florida", "Florida", "entity"),
]
PAIRS = [
    ("NORTH FRANKLIN STREET IS CLOSED", "North Franklin Street is closed"),
    ("THE CDBG GRANT WAS APPROVED", "The CDBG grant was approved"),
    ("JOHNSON-VELEZ SECONDED THE MOTION", "Johnson-Velez seconded the motion"),
    ("SPRING HEIGHTS RESIDENTS SPOKE", "Spring Heights residents spoke"),
    ("THE FDOT PROJECT ON EAST KENNEDY BOULEVARD WAS DISCUSSED", "The FDOT project on East Kennedy Boulevard was discussed"),
    ("IT IS LATE. GIVE IT TO US, I SAID", "It is late. Give it to us, I said"),
    ("THE IT DEPARTMENT OF THE US IN FLORIDA HAS 12 MEN", "The IT department of the US in Florida has 12 men"),
    ("WE DON'T KNOW", "We don't know"),
]


def test_truecase(spark):
    d = spark.createDataFrame(DICTIONARY, "phrase string, proper string, kind string")
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(PAIRS)], "id int, t string")
    out = truecase.truecase(rows, "id", "t", d).orderBy("id").collect()
    assert [r["cased"] for r in out] == [b for _, b in PAIRS]
    again = truecase.truecase(spark.createDataFrame([(r["id"], r["cased"]) for r in out], "id int, t string"), "id", "t", d)
    assert [r["cased"] for r in again.orderBy("id").collect()] == [b for _, b in PAIRS]


def test_longest_phrase_first_ranks_and_predictions(spark):
    d = spark.createDataFrame(
        [("a b", "A B", "entity", 0), ("b c d", "B C D", "entity", 0), ("elmer city", "Elmer City", "entity", 1), ("elmer city", "ELMER CITY", "entity", 2)],
        "phrase string, proper string, kind string, rank int",
    )
    rows = spark.createDataFrame([(1, "X A B C D"), (2, "SEE OAKTON/ELMER CITY NOW"), (3, "OLD ROSE LANE")], "id int, t string")
    said = spark.createDataFrame([(3, "rose lane", "Rose Lane", "entity"), (2, "elmer city", "no", "entity")], "id int, phrase string, proper string, kind string")
    out = truecase.truecase(rows, "id", "t", d, predictions=said).orderBy("id").collect()
    assert [r["cased"] for r in out] == ["X a B C D", "See oakton/elmer City now", "Old Rose Lane"]


def test_apostrophes_can_be_dropped(spark):
    d = spark.createDataFrame(DICTIONARY, "phrase string, proper string, kind string")
    rows = spark.createDataFrame([(1, "WE DON'T KNOW")], "id int, t string")
    assert truecase.truecase(rows, "id", "t", d, keep_apostrophes=False).first()["cased"] == "We dont know"


@pytest.mark.parametrize(
    "s,number",
    [
        ("File No. PS25 - 1234 x", "PS25-1234"), ("TA/CPA25 - 09 hearing", "TA/CPA25-09"), ("FDN 25-36-C", "FDN 25-36-C"),
        ("administration update", "Administration Update"), ("nothing", None),
    ],
)
def test_file_number(spark, s, number):
    assert value(spark, text.file_number, s) == number


def test_small_functions(spark):
    assert value(spark, text.title_case, "the fdot report OF 2025-staff_notes.PDF") == "The FDOT Report of 2025-Staff_Notes.PDF"
    assert value(spark, text.sanitize_filename, " My (Old)  File.docx.pdf") == "my-old-file.pdf"
    assert value(spark, text.content_type, "a.xlsx").endswith("sheet") and value(spark, text.content_type, "a.bin") == "application/octet-stream"
    assert value(spark, text.to_ascii, "a–b “c” d… é") == 'a-b "c" d... -'
    assert value(spark, text.speaker_case, "  DAN   O'NEIL ") == "Dan O'neil"
    assert value(spark, text.normalize_name, "Chief Ann B. Lee, P.E.") == "Ann Lee"
    assert value(spark, text.agenda_type, "R E G U L A R  F I N A L") == "FINAL"
    assert value(spark, lambda t: text.map_record_key(t, F.lit(3)), "REZ-25-40") == "REZ-25-0000040:3"
    assert value(spark, lambda t: text.snippet(t, "to be"), "x" * 300 + " TO be") is not None
    assert value(spark, urls.direct_download, "/DownloadFile?x=1") == "/DownloadFileBytes?x=1"
    assert value(spark, urls.direct_download, "/DownloadFileBytes?x=1") == "/DownloadFileBytes?x=1"
    assert value(spark, rules.name_kind, "Acme Group") == "business" and value(spark, rules.name_kind, "Acme LLC") == "non_person"
    assert value(spark, rules.file_number_prefix, "REZ-25-1") == "REZ"
    assert [value(spark, lambda t: video.title_part_session(t)["part"], t) for t in ("x Pt2", "afternoon", "a PM b")] == [2, 2, 1]


def test_boilerplate(spark):
    clean = lambda t: boilerplate.clean_agenda_text(t, "Springfield")
    s = "File No. PS25-1  Resolution; authorizing the Mayor of the City of Springfield to execute said agreement; providing an effective date."
    assert value(spark, clean, s) == "**File No. PS25-1** Resolution."
    assert value(spark, clean, "Award - (Original motion by X) - (To be R/F)") == "Award."
    assert value(spark, clean, "Lease; authorizing the execution thereof by the Mayor and attestation by the City Clerk; and providing an effective date.") == "Lease."
    assert value(spark, clean, "Buy; authorizing the Director of Purchasing to purchase said property, supplies, materials or services; providing for severability") == "Buy."
    assert value(spark, clean, "Plan, and . Memorandum from J. Doe, Chief, transmitting a report for said item. Next step") == "Plan. Next step."
    kept = "Memorandum from A. Roe requesting that said public hearing be continued to May."
    assert value(spark, clean, kept) == kept
    assert value(spark, clean, "Rule; repealing conflicts; setting a fee; repealing conflicts") == "Rule; repealing conflicts; setting a fee."
    assert value(spark, clean, "Is it so?") == "Is it so?" and value(spark, clean, "") == "" and value(spark, clean, None) is None


def test_ngram_score(spark):
    score = lambda a, b: text.ngram_score(F.split(a, " "), F.split(b, " "), 3)
    assert value(spark, score, "A B C D", "X A B C D Y") == 1.0
    assert value(spark, score, "A B C D", "A B C E") == 0.5
    assert value(spark, score, "A B C D", "A D") == 0.5
    assert value(spark, text.substring_position, "z hello big wide world q", "say hello big wide world") is not None


def test_alignment_finds_a_planted_offset(spark):
    words = [f"{a}{b}" for a in ("alpha", "bravo", "carol", "delta", "echoe", "fargo") for b in ("one", "two", "six", "ten", "red", "blue")]
    segs = [("v", i, 32400 + i * 60, " ".join(words[i * 6 : i * 6 + 6])) for i in range(6)]
    caps = [("v", i, 100.0 + i * 60, " ".join(words[i * 6 : i * 6 + 6]), 0.1) for i in range(6)] + [("v", 9, 5.0, "noise only", 0.9)]
    c = spark.createDataFrame(caps, "video string, cap_id int, start double, text string, no_speech_prob double")
    s = spark.createDataFrame(segs, "video string, seg_id int, sec int, text string")
    out = align.align(c, s, "video").first()
    assert (out["offset"], out["n_pairs"]) == (100.0, 6)
    shuffled = c.withColumn("text", F.reverse("text"))
    assert align.align(shuffled, s, "video").count() == 0
    ref = spark.createDataFrame([("v", segs[2][3])], "video string, ref string")
    assert align.find_text(c, ref, "video", "ref").first()["start"] == 220.0
    s2 = s.withColumn("pos", F.col("seg_id"))
    assert align.match_start(c, s2, "video").first()["offset"] == 100.0
    assert align.first_caption_start(c, "video").first()["offset"] == 100.0


def test_ngram_join_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(12)]
    make = lambda n: [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 9))) for _ in range(n)]
    caps, segs = make(60), make(80) + ["w1 w2 w3 w4"] * 40  # a block of copies
    c = spark.createDataFrame([(0, i, t.split()) for i, t in enumerate(caps)], "k int, c int, w array<string>")
    s = spark.createDataFrame([(0, i, t.split()) for i, t in enumerate(segs)], "k int, s int, w array<string>")
    got = {(r["c"], r["s"]): r["score"] for r in align.ngram_matches(c, s, ["k"], "c", "s", "w", "w").collect()}

    def score(a, b):
        if len(a) < 3 or len(b) < 3:
            return sum(x in b for x in a) / len(a)
        grams = [tuple(a[i : i + 3]) for i in range(len(a) - 2)]
        have = {tuple(b[i : i + 3]) for i in range(len(b) - 2)}
        return sum(g in have for g in grams) / len(grams)

    want = {(i, j): score(a.split(), b.split()) for i, a in enumerate(caps) for j, b in enumerate(segs)}
    want = {k: v for k, v in want.items() if v >= 0.3}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_zoning(spark):
    t = "CURRENT ZONING: REQUESTED ZONING:\nPD (Planned) (REZ-22; Ord. 1) RM-16 (Multi)\nREQUESTED ZONING: CG\nFUTURE LAND USE: Urban Mixed (UMU)"
    z = value(spark, zoning.zoning, t)
    assert (z["current_zoning"], z["requested_zoning"], z["future_land_use"]) == ("PD", "CG", "Urban Mixed")
    w = value(spark, zoning.waivers_and_findings, "NEW WAIVER one\nmore\nFINDINGS: fine\nindeed\nPREPARED BY me")
    assert w["waivers"] == ["NEW WAIVER one more"] and w["findings"] == "FINDINGS: fine indeed"


def test_latest_report(spark):
    items = spark.createDataFrame([(1, "REZ-25-1", "x"), (2, "PS25-1", "y")], "item int, file_number string, title string")
    docs = spark.createDataFrame(
        [(1, "Staff Report Final 01.02.25", 0, "a"), (1, "Staff Report Final 03.02.2025", 1, "b"), (1, "STAFF REPORT FINAL long title", 2, "c"), (2, "Staff Report Final", 0, "d")],
        "item int, doc_title string, doc_pos int, url string",
    )
    rows = zoning.latest_reports(items, docs, ["item"]).collect()
    assert [(r["item"], r["url"], r["land_use_type"]) for r in rows] == [(1, "b", "REZONING")]


def test_diff_of_itself_is_empty(spark):
    s = spark.createDataFrame([(1, "t", [{"number": 1, "docs": [{"title": "a", "url": "u"}]}])], "id int, title string, agendaItems array<struct<number int, docs array<struct<title string, url string>>>>")
    assert diff.snapshot_diff(s, s, "id").count() == 0
    n = spark.createDataFrame([(1, "t2", [{"number": 1, "docs": [{"title": "a", "url": "other"}, {"title": "b", "url": "z"}]}])], s.schema)
    rows = {(r["path"], r["change"]) for r in diff.snapshot_diff(s, n, "id").collect()}
    assert rows == {("title", "value_change"), ("agendaItems[0].docs", "array_length_change"), ("agendaItems[0].docs[1]", "array_item_added")}
    summary = diff.change_summary(diff.snapshot_diff(s, n, "id"), "id", documents="docs").first()
    assert (summary["item_index"], summary["new_documents"], summary["changed_fields"]) == (0, 1, ["docs"])


def test_calendar_lines(spark):
    p = spark.createDataFrame([(1, 1, 5.0, 1.0, "b"), (1, 1, 1.0, 1.1, "a"), (1, 1, 1.0, 1.25, "c"), (1, 2, 0.0, 0.0, "d")], "doc int, page int, x double, y double, t string")
    rows = calendar.lines_from_positions(p, "doc", "page", "x", "y", "t").orderBy("page", "line_no").collect()
    assert [r["line"] for r in rows] == ["a b", "c", "d"]


def test_transcript_page(spark):
    page = "CITY COUNCIL\nTHURSDAY, MAY 1, 2025, 9:00 A.M.\nDISCLAIMER:\nnot official\n9:00:01AM >>CHAIR: GOOD MORNING.\nWELCOME.\n9:01:00AM >> \nSkip to top\n9:02:00AM >>CLERK:\n9:03:00AM >>MR. X: YES"
    df = spark.createDataFrame([(1, page)], "id int, t string")
    out = transcripts.parse_pages(df, html.lines_of(F.col("t")), ["id"], "CITY COUNCIL").first()
    assert (out["meeting_title"], out["disclaimer"], out["segment_count"]) == ("CITY COUNCIL", "not official", 2)
    assert [(s["timestamp"], s["speaker"], s["text"]) for s in out["segments"]] == [("9:00:01AM", "CHAIR", "GOOD MORNING. WELCOME."), ("9:03:00AM", "MR. X", "YES")]
    dropped = transcripts.parse_pages(df, html.lines_of(F.col("t")), ["id"], "CITY COUNCIL", keep_opening=False).first()
    assert [s["text"] for s in dropped["segments"]] == ["WELCOME."]
