"""License scans: exact phrases, and short notices with a bounded number of errors.

Exact part: a phrase occurs where its words stand consecutively.  Fuzzy part: a notice of m
characters that may differ by k edits is cut into k + 1 pieces; by the pigeonhole principle one
piece survives any k edits unharmed, so exact finds of the pieces give every place where the
notice can be.  Only there the bounded-error matcher runs; it verifies the edits and gives the
span.  Work is row-local (no shuffle), whole texts, memory bounded by one text.
"""

from __future__ import annotations

from functools import lru_cache
from typing import AnyStr

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from gavel.llm.common import ALNUM

#: The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices that the method looks for, with their labels and the edits allowed (about one in twelve characters).
NOTICES = {
    "released under the mit license": ("mit", 2),
    "licensed under the mit license": ("mit", 2),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 6),
    "licensed under the apache license version 2 0": ("apache-2", 3),
    "licensed under the gnu general public license": ("gpl", 3),
    "gnu lesser general public license": ("lgpl", 2),
    "gnu affero general public license": ("agpl", 2),
    "mozilla public license version 2 0": ("mpl-2", 2),
    "redistribution and use in source and binary forms": ("bsd", 4),
    "licensed under cc by nc": ("cc-by-nc", 1),
    "creative commons attribution noncommercial": ("cc-by-nc", 3),
    "creative commons attribution sharealike": ("cc-by-sa", 3),
    "this is free and unencumbered software released into the public domain": ("unlicense", 5),
}

_TO_WORDS = bytes(ord(chr(b).lower()) if b < 0x80 and ALNUM[b] else b if b >= 0x80 else 0x20 for b in range(256))
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first_word:long,last_word:long,edits:int>>"
)
NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of almost equal size, each with its place in the notice."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=None)
def _prepared() -> list[tuple[str, str, int, list[tuple[int, str]], regex.Pattern]]:
    return [
        (n, label, k, pieces(n, k), regex.compile(f"(?e)(?:{regex.escape(n)}){{e<={k}}}"))
        for n, (label, k) in NOTICES.items()
    ]


def places(joined: AnyStr, phrase: AnyStr) -> list[int]:
    """Starts of `phrase` in `joined`, overlaps included."""
    found, at = [], joined.find(phrase)
    while at >= 0:
        found.append(at)
        at = joined.find(phrase, at + 1)
    return found


def candidates(joined: str, notice: str, edits: int, seeds: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """Merged ranges of characters that can hold the notice: around each seed, as far as the edits can move it."""
    ranges = sorted(
        (max(0, hit - at - edits), hit - at + len(notice) + edits) for at, seed in seeds for hit in places(joined, seed)
    )
    merged: list[tuple[int, int]] = []
    for a, b in ranges:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def fuzzy_spans(joined: bytes) -> list[tuple[str, int, int, int, float]]:
    """(label, first word, last word, edits, similarity) of every verified notice, in text order, best first on a tie."""
    spans, text = [], joined.decode("utf-8", "surrogatepass")  # edits are counted in characters
    for notice, label, edits, seeds, pattern in _prepared():
        for a, b in candidates(text, notice, edits, seeds):
            for m in pattern.finditer(text[a:b]):
                wrong = sum(m.fuzzy_counts)
                start = a + m.start()
                first = text.count(" ", 0, start + (text[start : start + 1] == " ")) - 1
                spans.append((label, max(0, first), max(0, first) + m.group().strip(" ").count(" "), wrong, 1 - wrong / len(notice)))
    return sorted(spans, key=lambda s: (s[1], s[3], s[0]))


def scan(text: str | None) -> tuple:
    """One text's row; null and empty texts have no words, labels or places and score 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split(b" ")
    words = [w for w in words if w]
    joined = b" " + b" ".join(words) + b" "
    base, starts = set(), []
    for phrase, label in PHRASES.items():
        found = places(joined, f" {phrase} ".encode())
        starts += [joined.count(b" ", 0, at) for at in found]
        base |= {label} if found else set()
    spans = fuzzy_spans(joined)
    labels = base | {s[0] for s in spans}
    score = 1.0 if base else max((s[4] for s in spans), default=0.0)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted(labels)), score, [s[:4] for s in spans],
    )


def _scanned(texts: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([scan(t) for t in texts], columns=NAMES)
    return out.astype({"first_word": "Int64", "last_word": "Int64"})


def license_scan(text: Column) -> Column:
    """Labels, exact places and verified spans of a text column as one struct."""
    return F.pandas_udf(_scanned, SCHEMA)(text)
