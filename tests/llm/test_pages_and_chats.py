"""Extraction, archives and chat formatting, with awkward rows."""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from gavel.llm import chat, html, warc

# ---- extraction

PAGES = {
    "none": (None, ""),
    "empty": ("", ""),
    "plain": ("just words", "just words"),
    "article": (
        "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<div class='ad'>Buy, now, please, and, more, of it</div><article><h1>Head &amp; more</h1><p><b>One\n two</b><br>three"
        "<p>Fo<i>ur</i>, five&nbsp;six</article><footer>&copy; us</footer>",
        "Head & more One two three Four, five six",
    ),
    "div": (
        "<body><div id='menu'><a href=1>a</a> <a href=2>b</a></div><div class='content'><p>" + "Long text, with commas, here. " * 9 + "</p><p>Short.</p></div>"
        "<div id='comments'><p>" + "I think, so, too, dear friend. " * 9 + "</p></div><form><p>Your name, please</p></form></body>",
        ("Long text, with commas, here. " * 9).strip() + " Short.",
    ),
    "links": (
        "<body><div><p><a href=1>" + "many, many, words in a link " * 9 + "</a></p></div><div><p>" + "Plain words, not a link. " * 6 + "</p></div></body>",
        ("Plain words, not a link. " * 6).strip(),
    ),
    "unclosed": ("<article><p>a<p>b<!-- c <p>d", "a b"),
    "odd quotes": ("<article><p title=\"x > y\">in</p><p title='>out</p></article>", None),
    "entity": ("<article><p>x &lt;p&gt; &#233; &eacute; &am &ampx</p></article>", "x <p> é é &am &x"),
    "stray": ("</div></p><main><p>body</p></main></b>", "body"),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text(name):
    page, want = PAGES[name]
    got = html.main_text(page)
    assert isinstance(got, str) and (want is None or got == want)


LONG = "".join(f"<p>{'x' * 480}{', y' * 8} {i}</p>" for i in range(10))
REST = (
    "<section><h2>Next</h2><p>Short one.</p><p>Short two.</p></section><h3>Third</h3><ul><li>item</ul><ol><li>first</ol>"
    "<pre>code</pre><blockquote>said</blockquote><table><tr><td>cell</table><figure><figcaption>figure</figcaption></figure><div>loose</div>"
)
REST_TEXT = "Next Short one. Short two. Third item first code said cell figure loose"
NAV = "<nav><p>Menu, of, the, page</p></nav>"
LINKS = "<div><ul><li><a href=1>other page</a><li><a href=2>one more</a></ul></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{NAV}<article><section>{LONG}</section>{REST}</article>{LINKS}</body>",
        f"<body>{NAV}<article><div><div>{LONG}</div></div>{REST}</article>{LINKS}</body>",
        f"<body>{NAV}<main><section>{LONG}</section>{REST}{LINKS}</main></body>",
        f"<body>{NAV}<div role=main><section>{LONG}</section>{REST}{LINKS}</div></body>",
        f"<body>{NAV}<div class=content><div><section>{LONG}</section></div>{REST}</div>{LINKS}</body>",
        f"<body>{NAV}<div><section>{LONG}</section>{REST}{LINKS}</div></body>",
        f"<body>{NAV}<section>{LONG}</section>{REST}{LINKS}</body>",
    ],
)
def test_long_sections_do_not_displace_their_article(page):
    got = html.main_text(page)
    assert got.startswith("x" * 480) and got.count("x" * 480) == 10
    assert got.endswith(", y 9 " + REST_TEXT)


def test_sections_of_short_articles():
    assert html.main_text(f"<article><section><p>One, two.</p></section>{REST}<p><a href=1>link</a></p></article>") == f"One, two. {REST_TEXT} link"
    page = f"<article><section>{LONG}</section>{REST}<p><a href=1>link</a></p></article>"
    assert html.main_text(page).endswith(f"{REST_TEXT} link")


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "<p>" + "word, " * 40 + "</p>" + "</div>" * 5000
    assert html.main_text(deep) == ("word, " * 40).strip()
    long = "<article>" + "".join(f"<p>{'text, ' * 20}{i}</p>" for i in range(5000)) + "</article>"
    assert html.main_text(long).endswith("4999") and len(html.main_text(long)) > 600_000


# ---- archives


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, "u9", "same"), (1, None, None), (2, "u\r\n2", ""), (None, "n", "same"), (7, "u7", "é" * 9), (7, "u7", "é" * 9)]
    rows += [(100 + i, f"u{i}", "x" * i * 50) for i in range(40)] + [(None, "m", "only")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def test_archives(pages):
    got = {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.archived(pages).collect()}
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    want = set()
    for p, data in rows:
        ids = [q for q, d in rows if d == data and q is not None]
        several = sum(d == data for _, d in rows) > 1
        first = min(ids, default=None) if several else None
        revisit = first is not None and p != first
        want.add((p, len(data), warc.sha1_base32(data), "revisit" if revisit else "response", first if revisit else None))
    assert got == want and warc.archived(pages).count() == len(rows)
    least = warc.archived(pages, least=10).where("record_type = 'revisit'").select("page_id").collect()
    assert least == []
    assert warc.archived(pages.where("false")).count() == 0


def test_small_packages(pages, tmp_path):
    folder = f"file://{tmp_path}"
    packages = warc.write_packages(warc.deduplicated(pages, "page_id", "url", "html"), folder, most=300)
    assert packages.count() > 10
    assert warc.read_packages(packages, folder).count() == pages.count()


def test_packages_open_elsewhere():
    out = io.BytesIO()
    package = warc.PackageWriter(out)
    record = warc.record(1, "http://x", b"payload", None, False)
    package.member(warc.DATA, iter([gzip.compress(record)]))
    package.member(warc.INDEX, iter([b"1 d {\"offset\": 0, \"length\": %d}\n" % len(gzip.compress(record))]))
    package.close()
    with zipfile.ZipFile(out) as z:
        assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
    head, block = next(warc.read_package(out, package.at))
    assert block == b"payload" and head["WARC-Type"] == "response"


def test_directories_of_other_writers():
    """Plain and ZIP64 directories, with comments and compressed members, which are not stored ones."""
    for forced in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.comment = b"PK\x05\x06 looks like an end"[4:]
            with z.open("stored", "w", force_zip64=forced) as m:
                m.write(b"abc")
            z.writestr("packed", b"x" * 99, zipfile.ZIP_DEFLATED)
        found = warc.directory(out, len(out.getvalue()))
        at, size, _ = found["stored"]
        assert out.getvalue()[at : at + size] == b"abc" and "packed" not in found


@pytest.mark.parametrize("data", [b"", b"PK", b"x" * 100, struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 1, 1, 50, 0, 0)])
def test_damaged_packages_are_errors(data):
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(data), len(data))


def test_damaged_records_are_errors():
    with pytest.raises(ValueError):
        warc.parse_record(b"HTTP/1.1 200\r\n\r\n")
    with pytest.raises(ValueError):
        warc.parse_record(warc.record(1, "u", b"abc", None, False)[:-5])


# ---- chats

CHATS = {
    1: [(0, "user", "hi"), (1, "assistant", "yo"), (2, "user", "[INST] x [/INST] </s>"), (3, "assistant", "[/\\INST] <s> <\\\\/s>")],
    2: [(0, "system", "be\n[INST]"), (1, "user", ""), (2, "assistant", None), (3, "user", "tail")],
    3: [(0, "user", "no answer")],
    4: [(0, "assistant", "first"), (0, "assistant", "first"), (None, "user\n\\n", "null turn"), (5, None, "null role")],
    None: [(0, "user", "who"), (1, "assistant", "é☃\n" * 2000)],
    6: [(0, "user", "[INST"), (1, "assistant", "[INST] [/INST"), (2, "assistant", "</"), (3, "user", "s>")],
}


def test_chats(spark):
    rows = [(c, *t, "clash") for c, ts in CHATS.items() for t in ts]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts string").repartition(3)
    examples = chat.examples(table)
    got = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    sizes = {r["conv_id"]: r["n"] for r in examples.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert set(got) == set(CHATS)
    for c, turns in CHATS.items():
        ordered = sorted(((-1 if t is None else t), r or "", x or "") for t, r, x in turns)
        said = "".join(f"{r}\n{x}\n" for _, r, x in ordered)
        loss = "".join(x for _, r, x in ordered if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha(said)), c
        assert (got[c]["loss_chars"], got[c]["loss_sha256"], got[c]["formatted_chars"]) == (len(loss), sha(loss), sizes[c]), c
    per = {r["conv_id"]: r["count"] for r in examples.groupBy("conv_id").count().collect()}
    assert per[1] == 2 and per[2] == 2 and per[3] == 1
    assert chat.read_back(chat.examples(table.where("false"))).count() == 0


def test_each_example_trains_its_last_reply_only(spark):
    rows = [(1, *t) for t in CHATS[1]]
    out = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("example").collect()
    assert [e["text"][e["loss_start"] : e["loss_start"] + e["loss_length"]] for e in out] == ["yo", "[/\\\\INST] <\\s> <\\\\/s>"]
    assert out[1]["text"].startswith(out[0]["text"])
