"""Words for matching: found by one pattern per text, with the results of the word-by-word rules."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from gavel.functions import text
from gavel.plans import align

ODD = ["", " ", "the", "12", "a1b", "ab", "ABC_the", "straße", "ÀÉ", "the-end", " x yes", "'tis", "123", "1st", "😀and", "andy", "\n", "THEM", "then5", "_", "ﬁne"]


def _words(s: str) -> list[str]:
    return [w for w in re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9\s]", " ", s.upper(), flags=re.A), flags=re.A).split(" ") if w]


def test_words_follow_the_rules(spark):
    rng = random.Random(5)
    texts = [*ODD, *[rng.choice(["", " ", "-", "\t"]).join(rng.choices(ODD, k=rng.randrange(1, 12))) for _ in range(400)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    rows = df.select("i", text.match_words("t").alias("w"), text.content_words("t").alias("c"), text.normalize_for_match("t").alias("n"), text.ngrams(text.match_words("t"), 3).alias("g"), text.ascii_share("t").alias("a"))
    for r in rows.collect():
        if r["i"] == len(texts):
            assert r["w"] is None and r["c"] is None and r["n"] is None
            continue
        t, w = texts[r["i"]], _words(texts[r["i"]])
        assert r["w"] == w and r["n"] == " ".join(w)
        assert r["c"] == [x for x in w if len(x) >= 3 and re.search("[A-Z]", x) and x not in text.STOP_WORDS]
        assert r["g"] == [" ".join(w[k : k + 3]) for k in range(len(w) - 2)]
        assert r["a"] == (sum(ord(x) < 128 for x in t) / len(t) if t else 0.0)


def test_no_word_is_looked_at_by_a_lambda(spark):
    df = spark.createDataFrame([("a b",)], "t string").select(text.match_words("t"), text.content_words("t"))
    assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_ngram_score_counts_every_gram_of_the_caption(spark):
    rng = random.Random(8)
    pairs = [([rng.choice("ABCD") for _ in range(rng.randrange(1, 9))], [rng.choice("ABCDE") for _ in range(rng.randrange(1, 30))]) for _ in range(200)]
    pairs.append((list("ABCDEFG"), list("XABCDY")))
    for a, b, score in spark.createDataFrame(pairs, "a array<string>, b array<string>").select("a", "b", text.ngram_score(F.col("a"), F.col("b"), 3)).collect():
        xs, ys = ([s[k : k + 3] for k in range(len(s) - 2)] for s in (a, b)) if min(len(a), len(b)) >= 3 else (a, b)
        assert score == sum(x in ys for x in xs) / len(xs)


def test_texts_of_segments_are_read_by_one_branch(spark):
    words = F.split(F.concat(F.lit("MARK of a long text "), F.col("id").cast("string")), " ")
    segments = spark.range(9).select(F.lit(1).alias("v"), F.col("id").alias("seg_id"), words.alias("w"))
    captions = spark.createDataFrame([(1, 5, "MARK of a long text 3".split())], "v int, cap_id long, w array<string>")
    out = align.ngram_matches(captions, segments, ["v"], "cap_id", "seg_id", "w", "w")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert {(r["seg_id"], r["score"]) for r in out.collect()} == {(k, 1.0 if k == 3 else 0.75) for k in range(9)}
