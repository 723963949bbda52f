"""Links and items of a meeting: both roads against a plain loop, and no pieces of texts where a meeting is small."""

from __future__ import annotations

import random
import re

import pytest

from gavel.plans import manifest

LINKS = "m long, link_id string, number string, text string"
ITEMS = "m long, item_id string, item_no int, text string"


def _data():
    rng = random.Random(3)
    words = ["Oak", "ave", "A-1", "plan", "of", "--", "7"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    number = lambda: rng.choice([None, "", "x", "7", "17", "171", "42"])
    links = [(m, f"l{k}", number(), rng.choice([None, text(2), text(2)])) for m in range(12) for k in range(6)]
    items = [(m, rng.choice(["", "7", "71", "4", None]), k, text(6)) for m in range(11) for k in range(m)]
    return links, items


def _loop(links, items):
    squeeze = lambda t: re.sub("[^a-z0-9]", "", t)
    for m, ident, number, text in links:
        found = []
        for im, item_id, item_no, item_text in items:
            if im != m:
                continue
            lt, it = (text or "").lower(), item_text.lower()
            if number and item_id and (number in item_id or item_id in number):
                found.append((1, item_no, item_id))
            elif lt and lt in it:
                found.append((2, item_no, item_id))
            elif squeeze(lt) and squeeze(lt) in squeeze(it):
                found.append((3, item_no, item_id))
        best = min(found, key=lambda f: (f[0], f[1]), default=(None, None, None))
        yield (m, ident, best[2], best[0])


@pytest.mark.parametrize("few", [0, 20, 1000])
def test_both_roads(spark, monkeypatch, few):
    monkeypatch.setattr(manifest, "FEW_PAIRS", few, raising=False)
    links, items = _data()
    out = manifest.link_items(spark.createDataFrame(links, LINKS), spark.createDataFrame(items, ITEMS), "m")
    found = [(r["m"], r["link_id"], r["item_id"], r["tier"]) for r in out.collect()]
    assert sorted(found, key=lambda r: r[:2]) == sorted(_loop(links, items), key=lambda r: r[:2])


def test_small_meetings_are_not_cut_into_pieces(spark):
    links, items = _data()
    out = manifest.link_items(spark.createDataFrame(links, LINKS), spark.createDataFrame(items, ITEMS), "m")
    assert "explode" not in out._jdf.queryExecution().toString()
