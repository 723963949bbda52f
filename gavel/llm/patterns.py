"""Packing whole documents into few windows by patterns of lengths, fitted by non-negative least squares.

How many windows a corpus needs depends on its lengths alone, so it is planned on their histogram, which has one
count per length up to the window, whatever the size of the corpus.  All patterns of a few lengths that
fill a window are enumerated on coarse bins; repeat counts that explain the histogram best are fitted with
x >= 0, rounded, and filled with real lengths from the bins.  Lengths that no pattern took are residuals: in falling order
they go where they fit best, into the gaps of patterns or into new windows.  The plan says for the
n-th piece of every length in which window it lies and where.

Scale: texts are tokenised once, and slim rows (no ids unless asked for) are stored with their number among the equal lengths
of their task.  The count of each task and length, summed over the tasks before it, makes that number
global: no sort, and a length that a third of all pieces have is spread over as many tasks as made it.  The plan is bounded
by the window (4096 lengths), not by the corpus, so it travels with the tasks.

Cases: null and empty texts are the end id alone; repeated rows and null ids are packed like any others; extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.common import small_batches
from gavel.llm.tokens import shared_tokens
from gavel.session import stored

WINDOW = 4096
END_ID = 1
#: Coarse lengths of a window, and the most documents of a pattern.
BINS = 128
DEPTH = 3

PIECES = "doc long, piece int, start long, length long, ids_crc32 long, shard long, at long, ids binary"


def patterns(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All multisets of at most `depth` coarse lengths that fill a window exactly."""
    found = [(bins,)] if depth else []
    for n in range(1, depth):
        for some in combinations_with_replacement(range(1, bins), n):
            rest = bins - sum(some)
            if rest >= some[-1]:
                found.append((*some, rest))
    return found


def non_negative_fit(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with least |a x - b|, by active sets: the column with the steepest gradient enters, and columns
    that would turn negative leave."""
    n = a.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    limit = tolerance * max(float(np.abs(a.T @ b).max(initial=0)), 1e-300)
    for _ in range(3 * n):
        gradient = a.T @ (b - a @ x)
        gradient[inside] = -np.inf
        enters = int(np.argmax(gradient))
        if gradient[enters] <= limit:
            break
        inside[enters] = True
        while True:
            trial = np.zeros(n)
            trial[inside] = np.linalg.lstsq(a[:, inside], b, rcond=None)[0]
            bad = inside & (trial <= 0)
            if not bad.any():
                x = trial
                break
            step = np.min(x[bad] / (x[bad] - trial[bad] + 1e-300))
            x = x + step * (trial - x)
            inside &= x > 1e-12
            x[~inside] = 0
            if not inside.any():
                break
    return x


class Plan:
    """Where the pieces of every length go.

    `counts[n]` pieces have length n.  A group stands for many windows of one content: (number of windows, [(length,
    pieces of it in one window, first piece)]), so the plan does not grow with the corpus."""

    def __init__(self, counts: np.ndarray, window: int = WINDOW, bins: int = BINS, depth: int = DEPTH) -> None:
        self.window = window
        self.left, self.next = counts.astype(np.int64).copy(), np.zeros(window + 1, np.int64)
        self.room: list[int] = []  # free places of open groups, ascending and distinct
        self.open: dict[int, list[tuple[int, list[tuple[int, int, int]]]]] = {}
        if self.left.any():
            self._fit(min(bins, window), depth)
            self._residuals()

    def _add(self, free: int, windows: int, items: list[tuple[int, int, int]]) -> None:
        if not windows:
            return
        if free not in self.open:
            self.open[free] = []
            insort(self.room, free)
        self.open[free].append((windows, items))

    def _take(self, length: int, number: int) -> int:
        """The first of the next `number` pieces of a length."""
        first = int(self.next[length])
        self.next[length] += number
        self.left[length] -= number
        return first

    def _fit(self, bins: int, depth: int) -> None:
        width = -(-self.window // bins)
        bins = -(-self.window // width)
        bin_of = np.clip((np.arange(self.window + 1) + width // 2) // width, 1, bins)
        histogram = np.bincount(bin_of[1:], self.left[1:], bins + 1)[1:]
        shapes = patterns(bins, depth)
        a = np.zeros((bins, len(shapes)))
        for j, shape in enumerate(shapes):
            for b in shape:
                a[b - 1, j] += 1
        weight = np.arange(1, bins + 1) / bins  # short residuals find a gap, long ones do not
        times = np.rint(non_negative_fit(a * weight[:, None], histogram * weight)).astype(np.int64)
        stock = [np.flatnonzero(bin_of[1:] == b)[::-1] + 1 for b in range(1, bins + 1)]
        for j in sorted(np.flatnonzero(times > 0), key=lambda j: shapes[j][-1], reverse=True):
            self._repeat(shapes[j], int(times[j]), stock, 2 * width)

    def _repeat(self, shape: tuple[int, ...], times: int, stock: list[np.ndarray], slack: int) -> None:
        """Windows of one pattern: the longest pieces of its longer bins, closed by the piece that leaves least room.

        Bins round lengths, so the last piece is looked for among all lengths from `slack` below the room that is left.
        A window without one stays open for the residuals."""
        while times:
            drawn: Counter[int] = Counter()
            for b in shape[:0:-1] or shape:
                found = [n for n in stock[b - 1] if self.left[n] > drawn[n]]
                if not found:
                    return
                drawn[int(found[0])] += 1
            room = self.window - sum(n * m for n, m in drawn.items())
            if room < 0:  # rounded down too often: the residuals will do better
                return
            low = max(1, room - slack)
            near = [n for n in (np.flatnonzero(self.left[low : room + 1]) + low).tolist() if self.left[n] > drawn[n]]
            if near and len(shape) > 1:
                drawn[near[-1]] += 1
            k = min(times, *(int(self.left[n]) // m for n, m in drawn.items()))
            self._add(self.window - sum(n * m for n, m in drawn.items()), k, [(n, m, self._take(n, k * m)) for n, m in drawn.items()])
            times -= k

    def _residuals(self) -> None:
        """What is left, longest first, each where it leaves the least room."""
        for n in range(self.window, 0, -1):
            while self.left[n]:
                want = int(self.left[n])
                at = bisect_left(self.room, n)
                if at == len(self.room):
                    self._add(self.window, -(-want // (self.window // n)), [])
                    at = len(self.room) - 1
                free = self.room[at]
                windows, items = self.open[free].pop()
                if not self.open[free]:
                    del self.open[free], self.room[at]
                each = free // n
                full = min(windows, want // each)
                some = 0 if full == windows else want - full * each
                parts = [(full, each), (1, some), (windows - full - 1, 0)] if some else [(full, each), (windows - full, 0)]
                done = 0
                for number, m in parts:
                    if not number:
                        continue
                    moved = [(size, k, first + done * k) for size, k, first in items]
                    if m:
                        moved.append((n, m, self._take(n, number * m)))
                    self._add(free - m * n, number, moved)
                    done += number

    def rows(self) -> np.ndarray:
        """(length, first piece, pieces of it in one window, first window, offset), by length and first piece."""
        out, base = [], 0
        for free in self.room:
            for windows, items in self.open[free]:
                offset = 0
                for n, m, first in items:
                    out.append((n, first, m, base, offset))
                    offset += n * m
                base += windows
        self.windows = base
        return np.array(sorted(out), np.int64).reshape(-1, 5)


_ARROW = pa.schema(
    [(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in PIECES.split(", ")]
)


def _chopper(path: str, end: int, window: int, keep_ids: bool):
    def chop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard, seen = shared_tokens(path, end), TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, begins = tokens.encode(batch.column(1))
            totals = np.diff(begins)
            number = -(-totals // window)
            row = np.repeat(np.arange(len(totals)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * window
            length = np.minimum(totals[row] - start, window)
            order = np.argsort(length, kind="stable")  # the number of each piece among equal lengths
            runs = length[order]
            place = np.arange(len(runs)) - np.searchsorted(runs, runs)
            at = np.empty(len(runs), np.int64)
            at[order] = place + seen[runs]
            seen += np.bincount(length, minlength=window + 1)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            lo = 4 * (begins[row] + start)
            cuts = [raw[a:b] for a, b in zip(lo.tolist(), (lo + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                    pa.array(np.full(len(row), shard), pa.int64()),
                    pa.array(at, pa.int64()),
                    pa.array([bytes(c) for c in cuts], pa.binary()) if keep_ids else pa.nulls(len(row), pa.binary()),
                ],
                schema=_ARROW,
            )

    return chop


def _placer(plan: np.ndarray, names: list[str], schema: pa.Schema):
    keys = (plan[:, 0] << 44) + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            _, first, m, base, offset = plan[np.searchsorted(keys, (length << 44) + nth, "right") - 1].T
            into = nth - first
            added = [pa.array(base + into // m, pa.int64()), pa.array(offset + into % m * length, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + added, schema=schema)

    return place


def pieces(
    documents: DataFrame,
    tokenizer: str,
    doc: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenised documents, cut only where they are longer than a window, numbered by task and length (`PIECES`)."""
    small_batches(documents.sparkSession, size=4 << 20)
    slim = documents.select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(_chopper(tokenizer, end, window, keep_ids), PIECES)


def packed(
    documents: DataFrame,
    tokenizer: str,
    doc: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end: int = END_ID,
    bins: int = BINS,
    depth: int = DEPTH,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ids (little-endian,
    32 bits each) if `keep_ids`.  Sequence ids are dense from 0."""
    cut = stored(pieces(documents, tokenizer, doc, text, window, end, keep_ids), "pieces")
    by_task = cut.groupBy("shard", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(by_task.select("shard", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "offsets")
    counts = np.zeros(window + 1, np.int64)
    for n, number in offsets.groupBy("length").agg(F.sum("n")).collect():  # at most one row per length
        counts[n] = number
    plan = Plan(counts, window, bins, depth).rows()
    names = [c.split()[0] for c in PIECES.split(", ")[:5]] + (["ids"] if keep_ids else [])
    numbered = cut.join(offsets.select("shard", "length", "before"), ["shard", "length"])
    numbered = numbered.select(*names, (F.col("before") + F.col("at")).alias("nth"))
    arrow = pa.schema([_ARROW.field(c) for c in names] + [("sequence_id", pa.int64()), ("offset", pa.int64())])
    spark_schema = ", ".join(c for c in PIECES.split(", ") if c.split()[0] in names) + ", sequence_id long, offset long"
    return numbered.mapInArrow(_placer(plan, names, arrow), spark_schema).withColumnRenamed("doc", "doc_id")
