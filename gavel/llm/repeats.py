"""Suffix-array removal of strings of 200 bytes that occur twice or more in the corpus.

Occurrences must meet before suffixes can be compared.  Every 200-byte window is therefore assigned to
one anchor: the leftmost least hash among its 40-byte grams, which depends on the window's bytes alone, so equal
windows have equal anchors.  The windows of one anchor are neighbours and form a segment.

1. Facts: per text its digest and its anchors.  Equal whole texts are settled by digest; one of them goes on.
2. Anchors that occur once in the corpus cannot lie in a repeated window and are dropped: no guess, no loss.
3. Segments of the other anchors are cut from the texts, equal ones combined before the shuffle, and dealt by anchor
   to shards.  An anchor with very many occurrences is dealt by the 80 bytes beside it as well: each of its windows
   covers the 80 bytes to its left, or those to its right.  A key that is still hot (the edge of a frequent passage, with
   ever other neighbours) is cut to single windows, which are dealt and counted by their whole content.
4. A shard gets a suffix array (Larsson-Sadakane) and common prefixes (Kasai); neighbours that share 200 bytes are
   repeats.  Shards that meet in one task are merged by binary search of each other's windows.
5. Verdicts return by segment digest, and texts lose the covered bytes.

Scale: shuffled are anchors (about 1 in 80 bytes), the texts once, and the distinct candidate segments.  Groups
are never collected: copies combine, hot anchors are split by content, shards and tasks are bounded in bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import as_bytes, byte_values, digest, mixed, small_batches
from gavel.llm.suffixes import common_prefixes, find_prefixes, packed_words, suffix_array
from gavel.session import stored

SIZE = 200
GRAM = 40
SPREAD = SIZE - GRAM + 1
CONTEXT = (SIZE - GRAM) // 2  # no more: a window need not cover a longer stretch on either side of its anchor
HOT = 20_000
SHARD_BYTES = 3 << 20
TASK_BYTES = 6 << 20

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                _POWERS[name] = np.cumprod(table)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(raw: np.ndarray, size: int = GRAM) -> np.ndarray:
    """64-bit hashes of all runs of `size` bytes, by differences of one running sum."""
    up, down = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[: len(raw)], out=sums[1:])
        n = len(raw) - size + 1
        return mixed((sums[size:] - sums[:n]) * up[:n])


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values the place of its leftmost least one (two passes over blocks)."""
    n = len(values)
    blocks = -(-n // width)
    top = np.iinfo(np.uint64).max
    v = np.full(blocks * width, top, np.uint64)
    v[:n] = values
    v = v.reshape(blocks, width)
    place = np.arange(blocks * width).reshape(blocks, width)
    tail = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1]
    tail_at = np.minimum.accumulate(np.where(v == tail, place, blocks * width)[:, ::-1], axis=1)[:, ::-1].ravel()
    head = np.minimum.accumulate(v, axis=1)
    fresh = np.ones_like(v, bool)
    fresh[:, 1:] = head[:, 1:] < head[:, :-1]
    head_at = np.maximum.accumulate(np.where(fresh, place, 0), axis=1).ravel()
    tail, head = tail.ravel(), head.ravel()
    first = np.arange(n - width + 1)
    last = first + width - 1
    return np.where(tail[first] <= head[last], tail_at[first], head_at[last])


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor place, anchor hash) of the windows of a text, in order."""
    raw = np.frombuffer(data, np.uint8)
    none = np.zeros(0, np.int64)
    if len(raw) < SIZE:
        return none, none, none, none
    hashes = gram_hashes(raw)
    at = leftmost_least(hashes, SPREAD)
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], cut])
    last = np.append(cut, len(at)) - 1
    return first, last, at[first], hashes[at[first]].view(np.int64) >> 1


def segments(data: bytes, wanted: dict[int, bool], single: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(dealing key, start, end) of the segments whose anchor is wanted; a hot anchor's are cut by the side of their context.

    Where that key is in `single`, every window is a segment of its own."""
    first, last, place, anchor = runs(data)
    for s0, s1, a, h in zip(first.tolist(), last.tolist(), place.tolist(), anchor.tolist(), strict=True):
        hot = wanted.get(h)
        if hot is None:
            continue
        if not hot:
            yield h, s0, s1 + SIZE
            continue
        edge = a - CONTEXT  # windows up to here cover the context to the left, later ones that to the right
        sides = []
        if s0 <= edge:
            sides.append((_key(h, 0, data[a - CONTEXT : a]), s0, min(s1, edge)))
        if s1 > edge:
            sides.append((_key(h, 1, data[a + GRAM : a + GRAM + CONTEXT]), max(s0, edge + 1), s1))
        for key, w0, w1 in sides:
            if key in single:
                yield from ((_key(h, 2, data[w : w + SIZE]), w, w + SIZE) for w in range(w0, w1 + 1))
            else:
                yield key, w0, w1 + SIZE


def _key(anchor: int, side: int, context: bytes) -> int:
    raw = hashlib.blake2b(context, digest_size=8, salt=bytes([side]), key=anchor.to_bytes(8, "little", signed=True)).digest()
    return int.from_bytes(raw, "little", signed=True) >> 1


def name_of(segment: bytes) -> bytes:
    return hashlib.blake2b(segment, digest_size=16).digest()


# ---- one task's shards


class Shard:
    """Suffix array over distinct segments, and which of their windows are repeated."""

    def __init__(self, parts: list[bytes]) -> None:
        self.starts = np.cumsum([0] + [len(p) + 1 for p in parts])
        raw = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)  # 0xFF is no byte of UTF-8
        self.words = packed_words(raw)
        sizes = np.diff(self.starts) - 1
        valid = np.zeros(len(raw) + 1, np.int32)
        np.add.at(valid, self.starts[:-1], 1)
        np.add.at(valid, self.starts[:-1] + sizes - SIZE + 1, -1)
        self.valid = np.cumsum(valid[:-1]) > 0
        order = suffix_array(self.words, span=8)  # whole suffixes, as equal windows may go on equally
        equal = common_prefixes(self.words, order, SIZE) >= SIZE
        equal[0] = False
        ok = self.valid[order]
        self.rows = order[ok]
        pair = equal & ok
        self.repeated = np.zeros(len(raw), bool)
        self.repeated[order[pair]] = True
        self.repeated[order[np.flatnonzero(pair) - 1]] = True

    def merge(self, other: Shard) -> None:
        """Mark windows that stand in both shards, by binary search of the other's windows here."""
        at = other.rows
        low, high = find_prefixes(self.words, self.rows, other.words, at, SIZE)
        found = low < high
        other.repeated[at[found]] = True
        mark = np.zeros(len(self.rows) + 1, np.int64)
        np.add.at(mark, low[found], 1)
        np.add.at(mark, high[found], -1)
        self.repeated[self.rows[np.cumsum(mark[:-1]) > 0]] = True

    def ranges(self, i: int) -> list[tuple[int, int]]:
        """Runs of repeated windows in segment i, as offsets with exclusive ends."""
        hit = self.repeated[self.starts[i] : self.starts[i + 1] - SIZE]
        edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))


def _shards(parts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start = size = 0
    for i, p in enumerate(parts):
        if i > start and size + len(p) > SHARD_BYTES:
            yield start, parts[start:i]
            start, size = i, 0
        size += len(p) + 1
    if start < len(parts):
        yield start, parts[start:]


def repeated_ranges(parts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For distinct segments the runs of windows that occur again within them or in another."""
    out: list[list[tuple[int, int]]] = []
    shards = [Shard(p) for _, p in _shards(parts)]
    for j, b in enumerate(shards):
        for a in shards[:j]:
            a.merge(b)
    for s, (_, p) in zip(shards, _shards(parts), strict=True):
        out += [s.ranges(i) for i in range(len(p))]
    return out


# ---- jobs

_FACTS = pa.schema([("row", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.binary()), ("anchors", pa.list_(pa.int64()))])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row, data in zip(batch.column(0).to_pylist(), byte_values(batch.column(1)), strict=True):
            values, counts = np.unique(runs(data)[3], return_counts=True)
            rows.append((row, len(data), digest(data), ((values << 1) | (counts > 1)).tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FACTS, strict=True)], schema=_FACTS)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that need segments: one row per text that comes again right after itself."""
    last = None
    for batch in batches:
        keep = []
        for sha in batch.column("sha").to_pylist():
            keep.append(sha != last)
            last = sha
        yield batch.filter(pa.array(keep))


def _wanted(anchors: list[int]) -> dict[int, bool]:
    return {a >> 1: bool(a & 1) for a in anchors}


_SEGMENTS = pa.schema([("t", pa.int64()), ("name", pa.binary()), ("key", pa.int64()), ("segment", pa.binary()), ("n", pa.int64())])


def _cutter(with_bytes: bool, single: frozenset[int] = frozenset()):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, data, anchors in zip(batch.column("t").to_pylist(), byte_values(batch.column("text")), batch.column("anchors").to_pylist(), strict=True):
                found: dict[bytes, list[int]] = {}
                for key, a, b in segments(data, _wanted(anchors), single):
                    found.setdefault(data[a:b], [key, 0])[1] += 1
                rows += [(t, name_of(s), key, s if with_bytes else None, n) for s, (key, n) in found.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEGMENTS, strict=True)], schema=_SEGMENTS)

    return cut


_CUT = "t long, name binary, key long, segment binary, n long"
_RANGE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts on the distinct segments of one task."""
    names, parts, several = [], [], []
    for batch in batches:
        names += batch.column("name").to_pylist()
        parts += batch.column("segment").to_pylist()
        several += [n > 1 for n in batch.column("n").to_pylist()]
    if not parts:
        return
    ranges = repeated_ranges(parts)
    whole = [[(0, len(p) - SIZE + 1)] if s else r for p, s, r in zip(parts, several, ranges, strict=True)]
    hit = [i for i, r in enumerate(whole) if r]
    for at in range(0, len(hit), 10_000):
        some = hit[at : at + 10_000]
        told = [[{"a": a, "b": b} for a, b in whole[i]] for i in some]
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in some], pa.binary()), pa.array(told, _RANGE)], names=["name", "ranges"])


def covered(data: bytes, wanted: dict[int, bool], verdicts: dict[bytes, list], single: frozenset[int] = frozenset()) -> list[tuple[int, int]]:
    """Maximal removed byte runs of a text."""
    mark = np.zeros(len(data) + 1, np.int32)
    for _, s, e in segments(data, wanted, single):
        for r in verdicts.get(name_of(data[s:e]), ()):
            mark[s + r["a"]] += 1
            mark[s + r["b"] - 1 + SIZE] -= 1
    edges = np.diff(np.concatenate([[0], (np.cumsum(mark) > 0).astype(np.int8)]))
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


_DONE = pa.schema([("sha", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha", pa.binary()), ("kept", pa.string())])


def _cleaner(with_text: bool, single: frozenset[int]):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("sha", "text", "anchors", "verdicts"))
            for sha, data, anchors, verdicts in zip(*columns, strict=True):
                spans = covered(data, _wanted(anchors), {v["name"]: v["ranges"] for v in verdicts}, single)
                kept = without(data, spans)
                rows.append((sha, len(data) - len(kept), len(spans), digest(kept), kept.decode("utf-8", "ignore") if with_text else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _DONE, strict=True)], schema=_DONE)

    return clean


def facts_of(documents: DataFrame, row: str, text: str) -> DataFrame:
    """row, n_bytes, sha, anchors of every document, stored."""
    slim = documents.select(F.col(row).cast("long").alias("row"), as_bytes(text).alias("text"))
    return stored(slim.mapInArrow(_facts, "row long, n_bytes long, sha binary, anchors array<long>"), "facts")


def _id(sha: str) -> F.Column:
    """64 bits of a digest, to route by; a chance meeting of two texts only brings candidates together."""
    return F.xxhash64(sha)


def _still_hot(touched: DataFrame) -> frozenset[int]:
    """Keys of hot anchors with more than HOT different segments; each stands for megabytes of text, so they are few."""
    hot = F.filter("anchors", lambda a: a.bitwiseAND(F.lit(1)) == 1)
    some = touched.withColumn("anchors", hot).where(F.size("anchors") > 0)
    if some.select("t").isEmpty():
        return frozenset()
    cut = some.mapInArrow(_cutter(False), _CUT).select("key", "name").distinct()
    return frozenset(r[0] for r in cut.groupBy("key").count().where(F.col("count") > HOT).select("key").toLocalIterator())


def changed_texts(documents: DataFrame, facts: DataFrame, text: str = "text", with_text: bool = False) -> DataFrame:
    """sha, n_removed, n_spans, kept_sha (and kept) of every distinct text that holds candidates.

    Texts that occur as whole copies are among them, but `copies_of` overrules what is said of them here."""
    texts = facts.groupBy("sha").agg(F.first("anchors").alias("anchors"))
    anchors = texts.select(_id("sha").alias("t"), F.explode("anchors").alias("a"))
    anchors = anchors.select("t", F.shiftright("a", 1).alias("anchor"), (F.col("a").bitwiseAND(1) + 1).alias("n"))
    many = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    many = many.select("anchor", (F.col("n") > HOT).cast("long").alias("hot"))
    wanted = anchors.select("t", "anchor").join(many, "anchor")
    wanted = wanted.groupBy("t").agg(F.collect_list(F.shiftleft("anchor", 1).bitwiseOR(F.col("hot"))).alias("anchors"))
    rows = documents.select(as_bytes(text).alias("text")).where(F.length("text") >= SIZE)
    rows = rows.withColumn("sha", F.unhex(F.sha2("text", 256))).withColumn("t", _id("sha"))
    joined = rows.join(wanted, "t").select("t", "sha", "text", "anchors")
    touched = stored(joined.mapInArrow(_once, "t long, sha binary, text binary, anchors array<long>"), "touched")
    single = _still_hot(touched)
    volume = touched.agg(F.sum(F.size("anchors"))).first()[0] or 0
    tasks = max(1, -(-volume * (SIZE + SPREAD // 2) // TASK_BYTES))
    each = touched.mapInArrow(_cutter(True, single), _CUT).groupBy("name", "key", "segment").agg(F.sum("n").alias("n"))
    verdicts = each.repartition(tasks, "key").mapInArrow(_judge, "name binary, ranges array<struct<a:int,b:int>>")
    told = touched.mapInArrow(_cutter(False, single), _CUT).select("t", "name").join(verdicts, "name")
    told = told.groupBy("t").agg(F.collect_list(F.struct("name", "ranges")).alias("verdicts"))
    last = touched.join(told, "t").select("sha", "text", "anchors", "verdicts")
    done = last.mapInArrow(_cleaner(with_text, single), "sha binary, n_removed long, n_spans long, kept_sha binary, kept string")
    return done.dropDuplicates(["sha"])


def copies_of(facts: DataFrame) -> DataFrame:
    """Digests of texts of at least 200 bytes that are whole copies of each other."""
    return facts.where(F.col("n_bytes") >= SIZE).groupBy("sha").count().where("count > 1").select(F.col("sha").alias("copy_sha"))


def report(documents: DataFrame, row: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Null and empty texts have no bytes; texts under 200 bytes lose none; a repeated row is a copy, so it loses all of a
    text of 200 bytes or more; extra columns are not read; an empty table gives no rows."""
    small_batches(documents.sparkSession)
    facts = facts_of(documents, row, text)
    changed = changed_texts(documents, facts, text).drop("kept").withColumnRenamed("sha", "changed_sha")
    rows = facts.select("row", "n_bytes", "sha")
    rows = rows.join(copies_of(facts), rows.sha == F.col("copy_sha"), "left")
    rows = rows.join(changed, rows.sha == F.col("changed_sha"), "left")
    copy = F.col("copy_sha").isNotNull()
    kept = F.when(copy, F.unhex(F.sha2(F.lit(b""), 256))).otherwise(F.coalesce("kept_sha", "sha"))
    return rows.select(
        F.col("row").alias("doc_id"),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.lower(F.hex(kept)).alias("kept_sha256"),
    )


def removed(documents: DataFrame, row: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their repeated bytes taken out; all rows and columns stay.

    Bytes left over from a character that was cut in half are dropped with it."""
    small_batches(documents.sparkSession)
    facts = facts_of(documents, row, text)
    changed = changed_texts(documents, facts, text, with_text=True).where("n_removed > 0")
    changed = changed.select(F.col("sha").alias("_changed_sha"), F.col("kept").alias("_kept"))
    copies = copies_of(facts).select(F.col("copy_sha").alias("_changed_sha"), F.lit("").alias("_kept"))
    new = changed.join(copies, "_changed_sha", "left_anti").unionByName(copies)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"), F.unhex(F.sha2(as_bytes(text), 256)).alias("_sha")
    )
    rows = rows.join(new, F.col("_sha") == F.col("_changed_sha"), "left")
    hit = F.col("_changed_sha").isNotNull()
    values = {text: F.when(hit, F.col("_kept")).otherwise(F.col(f"doc.`{text}`"))}
    if "n_chars" in documents.columns:
        values["n_chars"] = F.when(hit, F.length("_kept").cast("long")).otherwise(F.col("doc.n_chars"))
    return rows.select(*[values.get(c, F.col(f"doc.`{c}`")).alias(c) for c in documents.columns])
