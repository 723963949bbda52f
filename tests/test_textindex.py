"""The stored index against plain loops: batches, replays, odd texts, and what a query reads."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from gavel.plans.textindex import TextIndex
from gavel.queries import searching

WORD = re.compile(r"[^\W_]+")
QUERIES = [(1, "the of"), (2, "of THE of"), (3, "w1"), (4, "nothing here"), (5, ""), (6, None), (7, "été, naïve!"), (8, "the w3 the"), (9, "the")]


def _texts(seed, first, n):
    rng = random.Random(seed)
    words = ["the"] * 30 + ["of"] * 9 + ["w%d" % i for i in range(40)] + ["Été", "naïve"]
    rows = [(first + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(n)]
    return rows + [(first + n, None), (first + n + 1, ""), (first + n + 2, " .,; "), (first + n + 3, "the " * 500)]


def _words(text):
    return [w.lower() for w in WORD.findall(text or "")]


def _ranked(rows, k):
    docs = {i: _words(t) for i, t in rows}
    mean = sum(map(len, docs.values())) / len(docs)
    df = Counter(w for ws in docs.values() for w in set(ws))
    out = []
    for q, text in QUERIES:
        scores = []
        for i, ws in docs.items():
            tf = Counter(ws)
            hit = [w for w in set(_words(text)) if tf[w]]
            if hit:
                s = sum(
                    math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for w in hit
                )
                scores.append((-round(s, 9), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def _phrases(rows):
    out = []
    for q, text in QUERIES:
        p = _words(text)
        for i, t in rows:
            ws = _words(t)
            at = [k for k in range(len(ws) - len(p) + 1) if p and ws[k : k + len(p)] == p]
            if at:
                out.append((q, i, len(at), at[0]))
    return sorted(out)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    index = TextIndex(spark, str(tmp_path_factory.mktemp("index")), buckets=5)
    schema = "doc long, text string, term string, words int"
    table = lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    old, new, more = _texts(1, 0, 90), _texts(2, 0, 70), _texts(3, 1000, 60)
    index.add(table(old), "doc", "text", "b1")
    index.add(table(more), "doc", "text", "b2")
    index.add(table(new), "doc", "text", "b1")  # delivered again, with other texts and fewer documents
    index.add(table([]), "doc", "text", "b3")
    return index, new + more


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(QUERIES, "q long, text string")


def test_ranked(built, asked):
    index, rows = built
    found = [tuple(r) for r in index.ranked(asked, "q", "text", k=5).orderBy("query", "rank").collect()]
    want = _ranked(rows, 5)
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert all(abs(f[3] - w[3]) < 1e-8 for f, w in zip(found, want, strict=True))


def test_phrases(built, asked):
    index, rows = built
    assert sorted(map(tuple, index.phrases(asked, "q", "text").collect())) == _phrases(rows)


def test_no_queries(built, asked):
    index, _ = built
    assert index.ranked(asked.where("false"), "q", "text").count() == 0 == index.phrases(asked.where("false"), "q", "text").count()


def test_many_query_terms_are_joined_by_a_shuffle(built, asked, monkeypatch):
    monkeypatch.setattr("gavel.plans.textindex.BROADCAST_TERMS", 2)
    index, rows = built
    assert sorted(map(tuple, index.phrases(asked, "q", "text").collect())) == _phrases(rows)


def test_a_frequent_term_is_in_several_files_and_the_texts_are_not_read(built, asked):
    index, _ = built
    files = index.read("postings").where("term = 'the' AND batch = 'b1'").select("_metadata.file_path").distinct().count()
    assert files > 1
    plan = index.ranked(asked, "q", "text")._jdf.queryExecution().toString()
    assert "postings" in plan and "documents.parquet" not in plan


def test_queries_read_only_the_index(spark):
    plan = searching.indexed_search(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "documents.parquet" not in plan and "/postings" in plan
