"""Phrases found through the trie against every run of words of a text."""

from __future__ import annotations

import random
import re

import pytest

from gavel.plans import truecase
from gavel.plans.truecase import Caser, _grouped

WORDS = ["new", "york", "city", "hall", "st", "it's", "o-k", "ann'e", "x1", "of", "the", "U.S.", "mid-town"]


def _dictionary(rng):
    rows = []
    for n in (1, 1, 2, 3, 5):
        for _ in range(12):
            p = " ".join(rng.choice(WORDS) for _ in range(n)).lower()
            rows.append((p, p.upper(), rng.choice(["entity", "acronym", "lower"])))
    return sorted({(p, k): (p, c, k) for p, c, k in rows}.values()) + [("-dash", "-Dash", "entity"), ("", "", "entity")]


def _texts(rng):
    texts = [" ".join(rng.choice([*WORDS, "zz", "new york city hall", "a;b"]) + rng.choice(["", "", ",", ".", "  "]) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return [(i, t) for i, t in enumerate([None, "", "  ", "...", "NEW YORK", *texts])]


def _plain(text, phrases):
    """Every run of words with what stands between them, and every part without its marks."""
    low = (text or "").lower()
    words = [m.span() for m in re.finditer(r"\w+", low, re.ASCII)]
    runs = {low[a[0] : b[1]] for i, a in enumerate(words) for b in words[i:]}
    return {p for p in runs | {re.sub(r"[^\w-]", "", w, flags=re.ASCII) for w in low.split()} if p in phrases and p}


@pytest.mark.parametrize("small", [500_000, 0])
def test_phrases_in(spark, small):
    rng = random.Random(small + 1)
    entries, texts = _dictionary(rng), _texts(rng)
    dictionary = spark.createDataFrame(entries, "phrase string, proper string, kind string")
    table = spark.createDataFrame(texts, "id long, t string").repartition(3)
    found = {tuple(r) for r in truecase.phrases_in(table, "id", "t", dictionary, small).collect()}
    phrases = {e[0] for e in entries}
    assert found == {(i, p) for i, t in texts for p in _plain(t, phrases)}


def test_casing_with_own_entries_equals_the_whole_dictionary(spark):
    rng = random.Random(9)
    entries, texts = _dictionary(rng), _texts(rng)
    entries = [e for e in entries if e[0] not in ("", "-dash")]
    dictionary = spark.createDataFrame(entries, "phrase string, proper string, kind string")
    table = spark.createDataFrame(texts, "id long, t string")
    whole = Caser(_grouped(entries))
    found = dict(tuple(r) for r in truecase.truecase(table, "id", "t", dictionary).select("id", "cased").collect())
    assert found == {i: whole(t) for i, t in texts}


def test_an_empty_dictionary_changes_case_alone(spark):
    table = spark.createDataFrame([(1, "HELLO THERE. BYE"), (2, None)], "id long, t string")
    none = spark.createDataFrame([], "phrase string, proper string, kind string")
    assert dict(tuple(r) for r in truecase.truecase(table, "id", "t", none).select("id", "cased").collect()) == {1: "Hello there. Bye", 2: None}
