"""Similarity of captions: the same answers as all ratios, with few of them computed."""

from __future__ import annotations

import difflib
import random

import pyarrow as pa
import pytest

from gavel.functions.similarity import Bound, contenders, ratio_from
from gavel.plans import align


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


def said(rng, n):
    return " ".join(rng.choice(["the", "agenda", "item", "motion", "second", "vote", "é", "oak", "street", "to"]) for _ in range(n)).upper()


def test_bound_is_never_below_the_ratio():
    rng = random.Random(3)
    for _ in range(300):
        a, b = said(rng, rng.randrange(60)), said(rng, rng.randrange(60))
        assert Bound(a).of(b) >= ratio(a, b)
        assert ratio_from(a, b, ratio(a, b), {}) == ratio(a, b)


def test_ratios_after_a_good_one_are_not_computed():
    asked = []

    def offers(row):
        def of(floor):
            asked.append(row["cap_id"])
            return row["r"]

        yield 1, (), of

    schema = pa.schema([("v", pa.string()), ("cap_id", pa.int64()), ("ratio", pa.float64())])
    batch = pa.RecordBatch.from_pylist([{"v": v, "cap_id": i, "r": 0.8 if i == 2 else 0.1 * (i % 2)} for v in "ab" for i in range(1000)])
    out = [r for b in contenders(iter([batch.slice(0, 700), batch.slice(700)]), "v", "cap_id", offers, lambda r: r >= 0.7, 0.7, schema) for r in b.to_pylist()]
    assert len(asked) == 6 and [r["cap_id"] for r in out if r["ratio"] == 0.8] == [2, 2]


def captions(rng, videos, n):
    return [(v, i, float(i), said(rng, rng.randrange(1, 8)) if rng.random() < 0.9 else " . ") for v in range(videos) for i in range(n)]


@pytest.mark.parametrize("good", [0.7, 0.95])
def test_same_answers_as_all_ratios(spark, good):
    rng = random.Random(11)
    caps = captions(rng, 12, 25)
    refs = {v: said(rng, 14) if v % 3 else " ".join(c[3] for c in caps if c[0] == v and 5 <= c[1] < 9) for v in range(12)}
    c = spark.createDataFrame(caps, "video int, cap_id int, start double, text string")
    ref = spark.createDataFrame(list(refs.items()), "video int, ref string")

    def plain(t):
        return " ".join(t.replace(".", " ").split())

    wanted, starts = {}, {}
    segments = [(v, i, i, i * 60, said(rng, 12) if v % 2 else next(c[3] for c in caps if c[0] == v and c[1] == 7 + i) + " AND MORE") for v in range(12) for i in range(3)]
    for v in range(12):
        mine = [x for x in caps if x[0] == v]
        rows = [(i, k, ratio(plain(refs[v]), plain(" ".join(x[3] for x in mine[i : i + k])))) for i in range(25) for k in range(1, 6) if i + k <= 25]
        first = [r for r in rows if r[2] >= good] or [min(rows, key=lambda r: (-r[2], r[0], r[1]))]
        wanted[v] = (float(first[0][0]), first[0][2])
        pairs = [
            (i, p, max(r, 0.9) if plain(s).startswith(plain(x[3])[:20]) else r)
            for i, x in enumerate(mine) if len(x[3].strip(" ")) >= 10
            for p, s in enumerate(g[4] for g in segments if g[0] == v) if len(s) >= 10
            for r in [ratio(plain(x[3]), plain(s))]
        ]
        first = [r for r in pairs if r[2] > good] or [min(pairs, key=lambda r: (-r[2], r[0], r[1]))]
        starts[v] = (float(first[0][0] - 60 * first[0][1]) if first[0][2] >= 0.5 else 0.0, first[0][2])
    found = align.find_text(c, ref, "video", "ref", good)
    assert {r["video"]: (r["start"], r["ratio"]) for r in found.collect()} == wanted
    s = spark.createDataFrame(segments, "video int, seg_id int, pos int, sec int, text string")
    assert {r["video"]: (r["offset"], r["ratio"]) for r in align.match_start(c, s, "video", good=good).collect()} == starts
