"""Benchmark decontamination with an FM-index per training shard.

Windows of 13 words of every benchmark item are looked up in the documents.  A shard is a run of
documents of a partition, up to a bounded number of bytes.  Its words become symbols of the windows' own
alphabet; every other word is a separator, and so is the end of a document.  Stretches shorter than the
shortest window hold no window and are left out.  Over the rest the shard builds its FM-index: suffix
array, Burrows-Wheeler transform, the first-column counts, a wavelet matrix for ranks, and suffix
positions sampled every few symbols.  All windows are searched at once, last word first; the rows of a hit
are walked back to sampled positions; hit stretches are merged into removal spans in the documents.

Scale: no shuffle at all, one pass over the documents; memory is bounded by the shard, or by one
document that is larger.  Windows travel with the tasks as a query set.  A set of more than BLOCK_WINDOWS is cut on
Spark into blocks by hash, and searched with one pass over the documents per block; the finds of a text meet by its
digest, before spans are counted.  The driver holds one block at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import ALNUM, as_bytes, byte_values, small_batches, word_hashes
from gavel.llm.suffixes import suffix_array
from gavel.session import stored

WINDOW = 13
SHARD_BYTES = 6 << 20
SAMPLED = 8
#: Windows of one block of the query set.
BLOCK_WINDOWS = 500_000


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words, ASCII letters lower-cased."""
    return word_hashes(data.lower(), ALNUM)


def windows_of(text: bytes, n: int = WINDOW) -> set[bytes]:
    """The word hashes of all windows; a text of fewer words is one window, one without words has none."""
    words = words_of(text)[0]
    return {words[i : i + n].tobytes() for i in range(max(1, len(words) - n + 1) if len(words) else 0)}


class Phrases:
    """Windows of items, given as (item, window), as rows of symbols 1.. (0 pads at the front), with their items."""

    def __init__(self, pairs: Iterable[tuple[str, bytes]], n: int = WINDOW) -> None:
        owners: dict[bytes, set[int]] = {}
        number: dict[str, int] = {}
        for name, window in pairs:
            owners.setdefault(bytes(window), set()).add(number.setdefault(name, len(number)))
        self.names = list(number)
        rows = [np.frombuffer(k, np.uint64) for k in owners]
        self.owners = [sorted(v) for v in owners.values()]
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.vocabulary = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.uint64)
        self.symbols = np.zeros((len(rows), n), np.int64)
        for i, r in enumerate(rows):
            self.symbols[i, n - len(r) :] = np.searchsorted(self.vocabulary, r) + 1


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector with running counts per bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, bits: int) -> None:
        self.bits, self.counts, self.zeros = bits, [], []
        for b in range(bits - 1, -1, -1):
            bit = (sequence >> b) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.counts.append(ones)
            self.zeros.append(len(sequence) - int(ones[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(at), at.copy()
        for level, (ones, zeros) in enumerate(zip(self.counts, self.zeros, strict=True)):
            one = ((symbol >> (self.bits - 1 - level)) & 1) == 1
            low1, high1 = ones[low], ones[high]
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return high - low


class FMIndex:
    """Backward search and location over one sequence of symbols ≥ 0; 0 is the separator."""

    def __init__(self, text: np.ndarray, alphabet: int, sampled: int = SAMPLED) -> None:
        self.text_size = len(text)
        full = np.append(text + 1, 0)  # one end symbol below all others
        order = suffix_array(full)
        self.bwt = full[order - 1]
        self.first = np.zeros(alphabet + 3, np.int64)
        np.cumsum(np.bincount(full, minlength=alphabet + 2), out=self.first[1:])
        self.tree = WaveletMatrix(self.bwt, max(1, int(alphabet + 1).bit_length()))
        kept = (order % sampled == 0) | (self.bwt <= 1)  # also where the walk would pass a separator
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.samples = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of patterns; rows of `patterns` are right-aligned, 0 is no symbol."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.text_size + 1, np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((patterns[:, column] > 0) & (low < high))
            if not len(live):
                break
            c = patterns[live, column] + 1
            low[live] = self.first[c] + self.tree.rank(c, low[live])
            high[live] = self.first[c] + self.tree.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to sampled ones."""
        out, steps = np.empty(len(rows), np.int64), 0
        live, rows = np.arange(len(rows)), rows.copy()
        while len(live):
            done = self.kept[rows]
            out[live[done]] = self.samples[self.kept_before[rows[done]]] + steps
            live, rows = live[~done], rows[~done]
            c = self.bwt[rows]
            rows = self.first[c] + self.tree.rank(c, rows)
            steps += 1
        return out


def _stretches(symbols: np.ndarray, least: int) -> np.ndarray:
    """Places of symbols in stretches without separators of at least `least` symbols."""
    inside = np.zeros(len(symbols) + 2, np.int8)
    inside[1:-1] = symbols > 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    mark = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(mark, starts[long], 1)
    np.add.at(mark, ends[long], -1)
    return np.flatnonzero(np.cumsum(mark[:-1]))


def find(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Per text of one shard: number of words, merged word spans that lie in found windows, and found items."""
    words = [words_of(t)[0] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])  # a separator after each text
    vocabulary = phrases.vocabulary
    out: list = [(int(n), [], []) for n in sizes]
    if not len(vocabulary):
        return out
    symbols = np.zeros(int(starts[-1]), np.int64)
    for w, at in zip(words, starts, strict=False):
        place = np.minimum(np.searchsorted(vocabulary, w), len(vocabulary) - 1)
        symbols[at : at + len(w)] = np.where(vocabulary[place] == w, place + 1, 0)
    del words
    places = _stretches(symbols, int(phrases.sizes.min()))
    if not len(places):
        return out
    gap = np.flatnonzero(np.diff(places) > 1) + 1
    text = np.insert(symbols[places], gap, 0)  # one separator between stretches
    origin = np.insert(places, gap, -1)
    index = FMIndex(text, len(vocabulary))
    low, high = index.search(phrases.symbols)
    found = np.flatnonzero(high > low)
    if not len(found):
        return out
    counts = high[found] - low[found]
    rows = np.repeat(low[found] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    which = np.repeat(found, counts)
    at = origin[index.locate(rows)]
    text_of = np.searchsorted(starts, at, side="right") - 1
    by_text = np.lexsort((at, text_of))
    for i, group in _groups(text_of[by_text], by_text):
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for k in group:
            a = int(at[k] - starts[i])
            b = a + int(phrases.sizes[which[k]])
            items.update(phrases.owners[which[k]])
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
            else:
                spans.append((a, b))
        out[i] = (int(sizes[i]), spans, sorted(items))
    return out


def _groups(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.flatnonzero(np.diff(keys)) + 1
    for part in np.split(np.arange(len(keys)), cuts):
        if len(part):
            yield int(keys[part[0]]), values[part]


def shards(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the incoming batches with their texts, each slice up to `most` bytes (or one text)."""
    for batch in batches:
        texts = list(byte_values(batch.column(text)))
        start = size = 0
        for i, t in enumerate(texts):
            if i > start and size + len(t) > most:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def items_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """item, text of the query set; null ids and texts without words give nothing."""
    rows = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull())
    return rows.select(F.col(item).cast("string").alias("item"), as_bytes(text).alias("text")).distinct()


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = sum(len(windows_of(t)) for t in byte_values(batch.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])


def _picker(block: int, blocks: int):
    """(item, window) of one block; an item's windows, and a frequent window's items, are spread over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, windows = [], []
            for name, text in zip(batch.column("item").to_pylist(), byte_values(batch.column("text")), strict=True):
                seed = zlib.crc32(name.encode())
                mine = [w for w in windows_of(text) if zlib.crc32(w, seed) % blocks == block]
                names += [name] * len(mine)
                windows += mine
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(windows, pa.binary())], names=["item", "window"])

    return run


def block_of(items: DataFrame, block: int, blocks: int) -> Phrases:
    return Phrases(items.mapInArrow(_picker(block, blocks), "item string, window binary").toLocalIterator())


_FOUND = "n_words long, spans array<struct<first:long,end:long>>, items array<string>"


def _found(row: pa.Array, counts: list, spans: list, items: list) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    told = [[{"first": a, "end": b} for a, b in s] for s in spans]
    columns = [pa.array(counts, pa.int64()), pa.array(told, kind), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([row, *columns], names=["row", "n_words", "spans", "items"])


def _finder(phrases: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in shards(batches, "text", SHARD_BYTES):
            found = find(texts, phrases)
            names = [sorted(phrases.names[i] for i in items) for _, _, items in found]
            yield _found(part.column("row"), [n for n, _, _ in found], [s for _, s, _ in found], names)

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The finds of all blocks in a text as if they had been searched at once."""
    for batch in batches:
        finds = [f or [] for f in batch.column("finds").to_pylist()]
        counts = [len(words_of(t)[0]) for t in byte_values(batch.column("text"))]
        spans = [_merged([(s["first"], s["end"]) for f in fs for s in f["spans"]]) for fs in finds]
        yield _found(batch.column("row"), counts, spans, [sorted({i for f in fs for i in f["items"]}) for fs in finds])


def _in_blocks(slim: DataFrame, items: DataFrame, blocks: int, kind: str) -> DataFrame:
    """row and what was found in its text, block by block; each pass leaves only its hits, one row per distinct text."""
    sha = F.sha2("text", 256)
    hits = []
    for block in range(blocks):
        found = slim.select(sha.alias("row"), "text").mapInArrow(_finder(block_of(items, block, blocks)), f"row string, {_FOUND}")
        hits.append(stored(found.where(F.size("items") > 0).dropDuplicates(["row"]), "block"))
    every = reduce(DataFrame.unionByName, hits).groupBy(F.col("row").alias("sha")).agg(F.collect_list(F.struct("spans", "items")).alias("finds"))
    rows = slim.withColumn("sha", sha).join(every, "sha", "left").select("row", "text", "finds")
    return rows.mapInArrow(_united, f"row {kind}, {_FOUND}")


def judged(documents: DataFrame, benchmark: DataFrame, carry: tuple[str, ...], text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns in `carry` with n_words, spans (word places, end exclusive), items, n_hit and contaminated.

    Null and empty texts have no words and no hits; repeated rows are judged alike; a benchmark item of fewer than 13
    words is one window, an item without words none; items that share an id count once."""
    spark = documents.sparkSession
    small_batches(spark)
    items = stored(items_of(benchmark), "items")
    blocks = -(-(items.mapInArrow(_counter, "n long").agg(F.sum("n")).first()[0] or 0) // BLOCK_WINDOWS)
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]) if carry else F.struct(F.lit(0).alias("c0"))
    slim = documents.select(row.alias("row"), as_bytes(text).alias("text"))
    kind = slim.schema["row"].dataType.simpleString()
    if blocks > 1:
        found = _in_blocks(slim, items, blocks, kind)
    else:
        found = slim.mapInArrow(_finder(block_of(items, 0, 1)), f"row {kind}, {_FOUND}")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    found = found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)], "n_words", "spans", "items", hit.alias("n_hit"))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = judged(documents, benchmark, ("doc_id",))
    digest = F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they were."""
    names = documents.columns
    found = judged(documents, benchmark, tuple(names))
    return found.where(~F.col("contaminated")).select(*[F.col(f"`{c}`") for c in names])
