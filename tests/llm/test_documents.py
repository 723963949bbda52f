"""Operators over documents against plain versions, with awkward rows."""

from __future__ import annotations

import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from gavel.llm import decontaminate, jaccard, licenses, packing, quality, repeats, suffixes, toxicity  # noqa: E402
from gavel.llm.queries import tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, host string, row long, sha string, label string"


def _rows() -> list[dict]:
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base, passage, item = prose(300), prose(60), prose(30)
    texts = [None, "", " \n\t", "one", "One", "one two three", base, base, base.replace(" ", "\n", 3), "é" * 150, "é" * 150 + "x"]
    texts += [prose(80) + " " + passage + " " + prose(70), prose(40) + " " + passage, passage, item, prose(90) + " " + item + " " + prose(9)]
    words = base.split()
    texts += [" ".join(words[:k] + ["zzz"] + words[k + 1 :]) for k in (10, 100, 200)]
    texts += [" ".join(words + ["tail%d" % k] * 3) for k in range(3)]
    texts += ["same line here\n" * 40, "x " * 3000, "ab" * 500, prose(30_000), "a\x00b c\xa0d� Released under the MIT Licence.", "#$% " * 60]
    texts += ["Under the MIT license, under the mit LICENSE. Apache License, version 2.0; cc-by-nc", "<|endoftext|> don't A.B, x."]
    rows = [{"doc_id": i, "text": t, "source": "s%d" % (i % 3)} for i, t in enumerate(texts)]
    rows += [dict(rows[6]), {"doc_id": None, "text": base, "source": None}, {"doc_id": None, "text": None, "source": "bad"}]
    rows += [{"doc_id": 100 + i, "text": "short", "source": "bad"} for i in range(60)]
    rows += [{"doc_id": 900, "text": prose(100), "source": "bad"}]
    return [r | {"lang": None, "n_chars": None, "host": "h", "row": 7, "sha": "x", "label": "y"} for r in rows]


ROWS = _rows()
ITEM = ROWS[14]["text"]
ITEMS = [(1, ITEM), (2, "two words"), (3, None), (4, ""), (4, ITEM[:40]), (5, "one")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([tuple(r.get(c.split()[0]) for c in SCHEMA.split(", ")) for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(documents):
    return documents.where("false")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def _bag(rows):
    return sorted(map(repr, rows))


def test_quality(documents, nothing):
    found = quality.scored(documents, "text", "source", ("doc_id",)).collect()
    kept = brute.quality_keeps(ROWS)
    want = [(r["doc_id"], *brute.quality(r["text"]), k) for r, k in zip(ROWS, kept, strict=True)]
    assert _bag(map(tuple, found)) == _bag(want)
    assert not any(k for r, k in zip(ROWS, kept, strict=True) if r["source"] == "bad")
    left = quality.filtered(documents)
    assert left.columns == documents.columns
    assert _bag(r["doc_id"] for r in left.collect()) == _bag(r["doc_id"] for r, k in zip(ROWS, kept, strict=True) if k)
    assert quality.scored(nothing, "text", "source", ("doc_id",)).count() == 0 == quality.filtered(nothing).count()


def test_quality_by_salted_join(documents, monkeypatch):
    want = _bag(map(tuple, quality.scored(documents, "text", "source", ("doc_id",)).collect()))
    monkeypatch.setattr(quality, "BROADCAST_HOSTS", 0)
    assert _bag(map(tuple, quality.scored(documents, "text", "source", ("doc_id",)).collect())) == want


def test_jaccard(documents, nothing):
    want = [(r["doc_id"], len(brute.shingles(r["text"])), c) for r, c in zip(ROWS, brute.jaccard_classes(ROWS), strict=True)]
    assert _bag(map(tuple, jaccard.classes(documents).collect())) == _bag(want)
    assert jaccard.classes(nothing).count() == 0
    stays = jaccard.one_of_each(documents)
    assert stays.columns == documents.columns
    assert _bag(r["doc_id"] for r in stays.collect()) == _bag(d for d, n, c in want if d is None or n == 0 or d == c)


def test_jaccard_block_in_parts(spark, monkeypatch):
    """A chain of slowly changing texts, with texts that only share half, over blocks cut into parts."""
    monkeypatch.setattr(jaccard, "PART", 12)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    rng = random.Random(5)
    words = ["w%d" % i for i in range(120)]
    rows = []
    for i in range(150):
        words = list(words)
        words[rng.randrange(120)] = "n%d" % i
        rows.append({"doc_id": 1000 - i, "text": " ".join(words)})
    rows += [{"doc_id": 2000 + i, "text": " ".join(words[:60] + ["q%d_%d" % (i, k) for k in range(60)])} for i in range(5)]
    found = jaccard.classes(spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string"))
    want = [(r["doc_id"], len(brute.shingles(r["text"])), c) for r, c in zip(rows, brute.jaccard_classes(rows), strict=True)]
    assert _bag(map(tuple, found.collect())) == _bag(want)


def test_linked_sets_share_a_key():
    """No pair at the very edge of the similarity is lost, whatever its sizes."""
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 5, 8, 13, 20, 40, 77, 150, 400, 1500]:
        for _ in range(40):
            pool = np.unique(rng.integers(0, 1 << 63, 3 * n + 10, dtype=np.uint64))
            a, extra = pool[:n], pool[n:]
            drop = rng.integers(0, n + 1)
            while drop and 100 * (n - drop) < 85 * n:
                drop -= rng.integers(1, drop + 1)
            most = (100 * (n - drop) - 85 * n) // 85
            b = np.concatenate([a[drop:], extra[: max(0, most)]])
            if len(b):
                assert 100 * (n - drop) >= 85 * len(np.union1d(a, b))
                assert set(jaccard.keys(a).tolist()) & set(jaccard.keys(np.sort(b)).tolist())


def test_repeats(documents, nothing):
    texts = [(r["text"] or "").encode() for r in ROWS]
    spans = brute.repeats(texts)
    want = [
        (r["doc_id"], len(t), sum(b - a for a, b in s), len(s), brute.sha(brute.cut(t, s)))
        for r, t, s in zip(ROWS, texts, spans, strict=True)
    ]
    assert _bag(map(tuple, repeats.report(documents).collect())) == _bag(want)
    assert repeats.report(nothing).count() == 0
    left = repeats.removed(documents)
    assert left.columns == documents.columns
    kept = [(r["doc_id"], brute.cut(t, s).decode("utf-8", "ignore") if s else r["text"]) for r, t, s in zip(ROWS, texts, spans, strict=True)]
    assert _bag((r["doc_id"], r["text"]) for r in left.collect()) == _bag(kept)


@pytest.mark.parametrize("hot,shard", [(1, 1 << 20), (2, 700), (20_000, 500)])
def test_repeats_in_small_shards_and_hot_anchors(documents, monkeypatch, hot, shard):
    want = _bag(map(tuple, repeats.report(documents).collect()))
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    assert _bag(map(tuple, repeats.report(documents).collect())) == want


def test_equal_windows_of_hot_anchors_have_equal_keys():
    """Passages of 200 to 230 bytes with other neighbours, with their anchor at every offset."""
    rng, offsets = np.random.default_rng(7), set()

    def text(n):
        return rng.integers(97, 123, n, dtype=np.uint8).tobytes()

    def dealt(data, single=frozenset()):
        hot = dict.fromkeys(repeats.runs(data)[3].tolist(), True)
        found = list(repeats.segments(data, hot, single))
        assert sorted(w for _, a, b in found for w in range(a, b - 199)) == list(range(len(data) - 199))
        return {data[w : w + 200]: key for key, a, b in found for w in range(a, b - 199)}, found

    for i in range(3000):
        passage = text(200 + i % 31)
        (first, found), (second, _) = (dealt(text(210) + passage + text(210)) for _ in range(2))
        assert first.keys() & second.keys() >= {passage[k : k + 200] for k in range(len(passage) - 199)}
        assert all(first[w] == second[w] for w in first.keys() & second.keys())
        offsets.add(int(repeats.runs(passage[:200])[2][0]))
        if i < 20:
            cut, pieces = dealt(text(50) + passage, frozenset(k for k, _, _ in found))
            every, _ = dealt(text(90) + passage, frozenset(k for k, _, _ in found))
            assert all(cut[w] == every[w] for w in cut.keys() & every.keys())
    assert offsets == set(range(161))


@pytest.mark.parametrize("hot", [0, 3])
def test_repeats_of_frequent_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "TASK_BYTES", 20_000)
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [word(n) for n in range(200, 231)]
    texts = [word(rng.randint(0, 260)) + p + word(rng.randint(0, 260)) for p in passages for _ in range(5)]
    spans = brute.repeats([t.encode() for t in texts])
    want = [(i, len(t), sum(b - a for a, b in s), len(s), brute.sha(brute.cut(t.encode(), s))) for i, (t, s) in enumerate(zip(texts, spans, strict=True))]
    found = repeats.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert _bag(map(tuple, found.collect())) == _bag(want)


def test_long_common_passages_make_no_false_repeats():
    """Segments that share more than 256 bytes and go on in an order that is not that of the text."""
    rng = np.random.default_rng(11)

    def text(n):
        return rng.integers(97, 99, n, dtype=np.uint8).tobytes()

    for _ in range(400):
        long = text(300)
        parts = [text(rng.integers(1, 30)) + long + b"b" + text(29), text(rng.integers(1, 30)) + long + b"a" + text(29), text(361)]
        times = Counter(p[w : w + 200] for p in parts for w in range(len(p) - 199))
        want = [[w for w in range(len(p) - 199) if times[p[w : w + 200]] > 1] for p in parts]
        assert [[w for a, b in r for w in range(a, b)] for r in repeats.repeated_ranges(parts)] == want


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(2)
    for data in [b"", b"a", b"mississippi", b"ab" * 300, bytes(rng.integers(97, 99, 700, dtype=np.uint8)), b"\xc3\xa9" * 50 + b"x"]:
        symbols = np.frombuffer(data, np.uint8)
        order = suffixes.suffix_array(symbols.astype(np.int64))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        if len(data):
            words = suffixes.packed_words(symbols)
            marked = data + b"\xff" * 8
            packed = suffixes.suffix_array(words, span=8)
            assert [marked[i:] for i in packed] == sorted(marked[i:] for i in range(len(data)))
            shared = suffixes.common_prefixes(words, packed, 64)
            for j in range(1, len(data)):
                a, b = data[packed[j - 1] :], data[packed[j] :]
                n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
                assert min(n, 64) == shared[j] or n > shared[j] >= n - 8 and max(packed[j - 1], packed[j]) + n + 8 > len(data)


def test_decontamination(documents, nothing, benchmark):
    want = []
    for r in ROWS:
        n, hit, items = brute.hits(r["text"], [(str(i), t) for i, t in ITEMS])
        want.append((r["doc_id"], n, hit, len(items), brute.sha(",".join(items).encode()), hit > 0 and 20 * hit >= n))
    assert _bag(map(tuple, decontaminate.report(documents, benchmark).collect())) == _bag(want)
    assert decontaminate.report(nothing, benchmark).count() == 0
    assert decontaminate.report(documents, benchmark.where("false")).where("contaminated").count() == 0
    left = decontaminate.clean(documents, benchmark)
    assert left.columns == documents.columns
    assert _bag(r["doc_id"] for r in left.collect()) == _bag(w[0] for w in want if not w[-1])


def test_decontamination_in_blocks(documents, nothing, benchmark, monkeypatch):
    """More windows than go into one block, among them copies, a window of two items, and spans over several blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 7)
    more = [*ITEMS, (1, ITEM), (6, ITEM)]
    twice = benchmark.union(benchmark.where("item_id = 1")).union(benchmark.where("item_id = 1").selectExpr("6L", "text"))
    want = []
    for r in ROWS:
        n, hit, items = brute.hits(r["text"], [(str(i), t) for i, t in more])
        want.append((r["doc_id"], n, hit, len(items), brute.sha(",".join(items).encode()), hit > 0 and 20 * hit >= n))
    assert _bag(map(tuple, decontaminate.report(documents, twice).collect())) == _bag(want)
    assert decontaminate.report(nothing, twice).count() == 0
    left = decontaminate.clean(documents, twice)
    assert left.columns == documents.columns
    assert _bag(r["doc_id"] for r in left.collect()) == _bag(w[0] for w in want if not w[-1])


def test_fm_index_counts_and_places():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 5, 900)
    text[300:420] = text[100:220]
    index = decontaminate.FMIndex(text, 5)
    for n in (1, 3, 7, 50):
        starts = rng.integers(0, 850, 20)
        patterns = np.zeros((20, 50), np.int64)
        sought = []
        for i, s in enumerate(starts):
            p = text[s : s + n].copy()
            p[p == 0] = 1
            patterns[i, 50 - n :] = p
            sought.append(p.tolist())
        low, high = index.search(patterns)
        for i, p in enumerate(sought):
            places = sorted(index.locate(np.arange(low[i], high[i])).tolist())
            assert places == [k for k in range(len(text) - n + 1) if text[k : k + n].tolist() == p]


def test_packing(documents, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.packed(documents, tokenizer_path()).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    total = 0
    for doc in {r["doc_id"] for r in ROWS}:
        copies = [r["text"] or "" for r in ROWS if r["doc_id"] == doc]
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4") for t in copies]
        total += sum(map(len, want))
        if len(copies) == 1:
            pieces, at = sorted(by_doc[doc], key=lambda r: r["start"]), 0
            for p in pieces:
                assert p["start"] == at and p["doc_tokens"] == len(want[0])
                assert p["ids_crc32"] == zlib.crc32(want[0][at : at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(want[0])
    assert total == sum(r["length"] for r in rows)
    assert len(by_sequence) == -(-total // 4096)
    assert packing.packed(nothing, tokenizer_path()).count() == 0


def test_open_windows_are_bounded():
    rng, windows, out = random.Random(1), packing.Windows(0, 64, 4), []
    for d in range(500):
        out += windows.place(d, 0, b"\0\0\0\0" * rng.randint(1, 64), 64)
        assert len(windows.held) <= 4
    rest = windows.leftovers()
    assert len(out) + len(rest) == 500


def test_licenses(documents):
    found = documents.select("doc_id", licenses.license_scan(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    assert len(found) == len(ROWS)
    by = {r["doc_id"]: r for r in found}
    for r in (r for r in ROWS if r["doc_id"] is not None):
        words = brute.WORD.findall(brute.lower(r["text"]))
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            hit = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
            starts += hit
            labels |= {label} if hit else set()
        got = by[r["doc_id"]]
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == (
            len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
        )
        assert labels <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


def test_license_seeds_lose_no_match():
    """Every edited notice that the bounded-error pattern finds anywhere is found through its seeds."""
    import regex

    rng = random.Random(6)
    for notice, (label, edits) in licenses.NOTICES.items():
        for _ in range(12):
            text = list(notice)
            for _ in range(edits):
                k = rng.randrange(1, len(text) - 1)
                text[k : k + 1] = rng.choice([[], ["x"], [text[k], "y"]])
            joined = f" foo bar {''.join(text)} baz ".encode()
            if regex.search(f"(?:{regex.escape(notice)}){{e<={edits}}}", joined.decode()):
                assert label in {s[0] for s in licenses.fuzzy_spans(joined)}


@pytest.mark.parametrize("odd", ["x", "é", "“", "😀"])
def test_license_edits_of_wide_characters(odd):
    """All edits on one side of the one piece that survives, which is the last or the first."""
    for notice, (label, edits) in licenses.NOTICES.items():
        cut = [a for a, _ in licenses.pieces(notice, edits)]
        starts = [a + 1 for a in cut[:-1]], [a + 1 for a in cut[1:]]
        for places in starts:
            text = notice
            for at in reversed(places):
                text = text[:at] + odd + text[at:]
            found = licenses.fuzzy_spans(f" foo {odd * 3} {text} bar ".encode())
            assert label in {s[0] for s in found if s[1:4] == (2, 2 + text.count(" "), edits)}, text
    found = licenses.scan("see the GNU “Lesser” General Public License")
    assert found[5] == "lgpl" and found[7] == [("lgpl", 2, 6, 2)]


def test_toxicity(spark, documents, nothing):
    rng = random.Random(8)
    plain = ["".join(rng.choice("abcde") for _ in range(5)) for _ in range(300)]

    def text(bad):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        return " ".join(words + ["grumbl" + rng.choice(["ing", "ed", "er", "y", "es", "ish"]) for _ in range(3)] if bad else words)

    rows = [(i, text(i % 6 == 0), int(i % 6 == 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.scored(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [(r["predicted"], int(r["doc_id"] % 6 == 0)) for r in found if r["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    every = toxicity.scored(documents, labels).collect()
    assert len(every) == len(ROWS) and all(0 <= r["score"] <= 1 for r in every)
    assert toxicity.scored(nothing, labels).count() == 0
    assert {r["score"] for r in toxicity.scored(documents, labels.where("false")).collect()} == {0.0}


def test_pipeline_stages(spark, documents, benchmark, tmp_path):
    """Each stage on what its predecessor kept, against the plain versions in a row."""
    folder = str(tmp_path)
    documents.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    rows = [r for r, k in zip(ROWS, brute.quality_keeps(ROWS), strict=True) if k]
    rows = [r for r, c in zip(rows, brute.jaccard_classes(rows), strict=True) if r["doc_id"] is None or r["doc_id"] == c]
    data = [(r["text"] or "").encode() for r in rows]
    cleaned = [brute.cut(t, s).decode("utf-8", "ignore") for t, s in zip(data, brute.repeats(data), strict=True)]
    rows = [r | {"text": t} for r, t in zip(rows, cleaned, strict=True)]
    left = []
    for r in rows:
        n, hit, _ = brute.hits(r["text"], [(str(i), t) for i, t in ITEMS])
        if not (hit and 20 * hit >= n):
            left.append(r)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == documents.columns, name
    assert _bag((r["doc_id"], r["text"]) for r in docs.collect()) == _bag((r["doc_id"], r["text"]) for r in left)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in left}
