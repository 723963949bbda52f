"""Toxicity by subword bags: averaged n-gram embeddings under a linear softmax, trained jointly.

A word is the bag of its character 3- to 5-grams (with word marks) and itself, hashed into buckets; its
vector is the mean of theirs, a text's vector the mean of its distinct words' vectors, and a linear
softmax gives the class.  Embeddings and softmax are trained together in numpy by Adagrad.  Misspelt
or unseen words share n-grams, hence vectors, with known ones.

A toxic passage in a long text is diluted by the mean over the whole, so a text's distinct words, in the order
of their first places, are read in windows of 32 (the last one padded); its score is that of its highest window.  For training the windows of
a toxic text are unlabelled but for that one must be toxic, so training alternates: fit, then let each toxic
text stand with its highest window (multiple-instance learning).  Clean texts stand with all of theirs.

Training data: a bounded sample of labelled rows, at most `SAMPLE` texts of either class, taken in the order
of a hash of the id, and of each at most `WINDOWS` windows in hash order.  Both are documented bounds of
the fit alone: every row is scored on its whole text.  Labels are read for rows with crc32(id) mod 5 ≠ 0 only; labels, language,
source and id are never inputs of a score.

Scale: features are made on the executors; the model is one number per bucket when scoring (the softmax
of two classes is linear in the mean), 1 MB, and travels with the task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import ALNUM, grams, mixed, small_batches

BUCKETS = 1 << 18
DIMENSION = 8
SPAN = 32
GRAMS = (3, 4, 5)
SAMPLE = 1500
WINDOWS = 24
FOLDS = 5
#: Buckets found in fewer texts of the sample (or in under one in a hundred, if that is less) have no vector.
LEAST_TEXTS = 8
#: Fixed factor on the mean of a window, and the weight of clean texts against toxic ones.
SCALE = 8
CLEAN_WEIGHT = 3
#: A small sample is gone through more often, up to so many steps a round.
LEAST_STEPS = 200
CACHED_WORDS = 500_000

_TO_WORDS = bytes(ord(chr(b).lower()) if b < 0x80 and ALNUM[b] else b if b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Distinct words of the whole text, lower-cased, in the order of their first places."""
    words = dict.fromkeys((text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_WORDS).split(b" "))
    words.pop(b"", None)
    return list(words)


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of its word) of the words themselves and of all their character n-grams."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
        hashes = [mixed(np.add.reduceat(letters * power[np.arange(len(letters)) - first[owner]], first))]
    owners = [np.arange(len(words))]
    for n in GRAMS:
        if len(letters) >= n:
            inside = owner[: len(letters) - n + 1] == owner[n - 1 :]
            hashes.append(grams(letters, n)[inside])
            owners.append(owner[: len(letters) - n + 1][inside])
    return (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def spans_of(text: str | None) -> list[list[bytes]]:
    words = words_of(text)
    return [words[i : i + SPAN] for i in range(0, len(words), SPAN)]


def _bag(words: list[bytes], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of the mean of the words' means; buckets of too few texts are zero, and left out."""
    where, owner = subwords(words)
    weight = (SCALE / SPAN / np.bincount(owner)[owner]).astype(np.float32)
    used = common[where]
    if not used.any():
        return where[:1], np.zeros(1, np.float32)
    return where[used], weight[used]


class Model:
    """Embeddings and a two-class softmax."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
        self.weight = np.zeros((DIMENSION, 2), np.float32)
        self.bias = np.zeros(2, np.float32)
        self.sums = [np.full_like(x, 1e-6) for x in (self.embedding, self.weight, self.bias)]

    def vectors(self, where: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.embedding[where] * weight[:, None], starts, axis=0)

    def fit(self, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, importance: np.ndarray, epochs: int, rate: float) -> None:
        rng = np.random.default_rng(2)
        batches = max(1, len(bags) // 256)
        for _ in range(max(epochs, -(-LEAST_STEPS // batches))):
            order = rng.permutation(len(bags))
            for part in np.array_split(order, batches):
                sizes = np.array([len(bags[i][0]) for i in part])
                where = np.concatenate([bags[i][0] for i in part])
                weight = np.concatenate([bags[i][1] for i in part])
                hidden = self.vectors(where, weight, np.cumsum(sizes) - sizes)
                raw = hidden @ self.weight + self.bias
                p = np.exp(raw - raw.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(part)), labels[part]] -= 1
                p *= (importance[part] / importance[part].sum())[:, None]
                back = p @ self.weight.T
                self._step(1, hidden.T @ p + 1e-4 * self.weight, rate)
                self._step(2, p.sum(0), rate)
                grad = back[np.repeat(np.arange(len(part)), sizes)] * weight[:, None]
                sort = np.argsort(where, kind="stable")
                used, first = np.unique(where[sort], return_index=True)
                total = np.add.reduceat(grad[sort], first, axis=0)
                self.sums[0][used] += total**2
                self.embedding[used] -= rate * total / np.sqrt(self.sums[0][used])

    def _step(self, at: int, grad: np.ndarray, rate: float) -> None:
        self.sums[at] += grad**2
        (self.embedding, self.weight, self.bias)[at][...] -= rate * grad / np.sqrt(self.sums[at])

    def linear(self) -> tuple[np.ndarray, float]:
        """(one number per bucket, offset): the log-odds of class 1 are the weighted mean plus the offset."""
        return self.embedding @ (self.weight[:, 1] - self.weight[:, 0]), float(self.bias[1] - self.bias[0])


def train(texts: list[list[list[bytes]]], labels: list[int], rounds: int = 3) -> tuple[np.ndarray, float]:
    """Fit on texts given as windows of words."""
    model = Model()
    y = np.array(labels)
    seen = np.zeros(BUCKETS, np.int64)
    for spans in texts:
        seen[np.unique(subwords([w for s in spans for w in s])[0])] += 1
    common = seen >= min(LEAST_TEXTS, max(2, len(texts) // 100))
    model.embedding[~common] = 0
    bags = [[_bag(s, common) for s in spans] for spans in texts]
    chosen: list = [b for b in bags]
    for turn in range(rounds):
        flat = [b for bs in chosen for b in bs]
        target = np.repeat(y, [len(bs) for bs in chosen])
        share = np.concatenate([np.full(len(bs), 1 / len(bs) if t else 1.0) for bs, t in zip(chosen, y, strict=True)])
        ones = target == 1
        importance = np.where(ones, share / max(share[ones].sum(), 1e-9), CLEAN_WEIGHT * share / max(share[~ones].sum(), 1e-9)).astype(np.float32)
        model.fit(flat, target, importance * len(flat), epochs=4 if turn else 5, rate=0.1)
        if turn == rounds - 1:
            break
        per, offset = model.linear()
        chosen = []
        for bs, t in zip(bags, y, strict=True):
            odds = [float((per[w] * x).sum()) for w, x in bs]
            chosen.append([bs[int(np.argmax(odds))]] if t else bs)
    return model.linear()


def sample(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[list[list[list[bytes]]], list[int]]:
    """Windows and labels of at most `most` labelled texts of either class, none of a held-out id.

    Labels given twice count as toxic if any says so; null labels, ids and texts are skipped."""
    train_fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0
    known = labels.where(train_fold & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id"), F.lit(17))
    picks = [known.where((F.col("toxic") == 1) == F.lit(c)).orderBy(order, "doc_id").limit(most) for c in (True, False)]
    wanted = picks[0].union(picks[1])
    rows = documents.select("doc_id", "text").where(train_fold & F.col("text").isNotNull()).join(F.broadcast(wanted), "doc_id").select("text", "toxic")

    def windows(texts: pd.Series) -> pd.Series:
        def some(t: str) -> list[bytes]:
            spans = [b" ".join(s) for s in spans_of(t)]
            return sorted(spans, key=lambda s: (zlib.crc32(s), s))[:WINDOWS]

        return texts.map(some)

    got = rows.select(F.pandas_udf(windows, "array<binary>")("text").alias("w"), "toxic").collect()
    texts = sorted(([bytes(w) for w in r["w"]], int(r["toxic"] == 1)) for r in got if r["w"])
    return [[w.split(b" ") for w in t] for t, _ in texts], [y for _, y in texts]


class Scorer:
    """Scores of texts, in [0, 1]; a text without words gets the odds of an empty window, below one half."""

    def __init__(self, per: np.ndarray, offset: float) -> None:
        self.per, self.offset, self.cache = per, offset, {}

    def __call__(self, texts: list[str | None]) -> list[float]:
        words = [words_of(t) for t in texts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        new = list({w for ws in words for w in ws}.difference(self.cache))
        bucket, owner = subwords(new)
        if new:
            means = np.bincount(owner, self.per[bucket], len(new)) / np.bincount(owner, minlength=len(new))
            self.cache.update(zip(new, means.tolist(), strict=True))
        return [self._score(ws) for ws in words]

    def _score(self, words: list[bytes]) -> float:
        if not words:
            return float(min(0.25, 1 / (1 + np.exp(-self.offset))))
        values = np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))
        means = np.add.reduceat(values, np.arange(0, len(words), SPAN)) * (SCALE / SPAN)
        return float(1 / (1 + np.exp(-np.clip(means.max() + self.offset, -30, 30))))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Repeated rows get equal scores; null and empty texts get a low score; a null id is not held out; without
    labels of both classes every score is 0."""
    small_batches(documents.sparkSession)
    texts, y = sample(documents, labels)
    if len(set(y)) < 2:
        value: Column = F.lit(0.0)
    else:
        per, offset = train(texts, y)
        per = per.astype(np.float32)

        def scores(column: pd.Series) -> pd.Series:
            return pd.Series(_scorer(per, offset)(column.tolist()), dtype="float64")

        value = F.pandas_udf(scores, "double")(F.col("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    rows = documents.select("doc_id", held.alias("held_out"), value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


_HELD: dict[int, Scorer] = {}


def _scorer(per: np.ndarray, offset: float) -> Scorer:
    """The scorer of this worker for one model; its word cache outlives a batch."""
    key = hash((per.tobytes(), offset))
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Scorer(per, offset)
    return _HELD[key]
