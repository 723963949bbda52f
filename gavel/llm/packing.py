"""Packing tokenised documents into fixed windows, online and in bounded space.

Each partition keeps a fixed number of open windows.  A piece goes to the open window that it fills
best; if none has room, the fullest window is emitted and a new one opened.  Documents longer than a
window are cut into whole windows and a rest.  The windows still open at the end of a partition are
its leftovers: at most `OPEN` of them, whatever the partition's size.  They carry their token ids, meet
in groups of bounded size, and are poured together with free cuts, so a group ends with one window that
is not full at most.

Scale: no shuffle of texts or tokens except for leftovers (OPEN windows per partition).  The placing
pass is written once to the shared folder, so leftovers and emitted pieces come from one run of it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import small_batches
from gavel.llm.tokens import shared_tokens
from gavel.session import stored

WINDOW = 4096
OPEN = 64
END_ID = 2
#: Leftover windows that one task pours together.
GROUP_WINDOWS = 1024

PIECES = "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Windows:
    """The open windows of one partition."""

    def __init__(self, first_id: int, size: int = WINDOW, most: int = OPEN) -> None:
        self.size, self.most, self.next = size, most, first_id
        self.room: list[tuple[int, int]] = []  # (free places, id), sorted
        self.held: dict[int, list[tuple]] = {}

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, doc: int | None, start: int, ids: bytes, total: int) -> list[tuple]:
        """Put a piece into a window; the rows of the window that had to be emitted for it, if any."""
        n, out = len(ids) // 4, []
        at = bisect_left(self.room, (n, -1))
        if at < len(self.room):
            free, w = self.room.pop(at)
        else:
            if len(self.room) == self.most:
                out = self.emit(self.room.pop(0)[1])
            free, w = self.size, self.new()
            self.held[w] = []
        self.held[w].append((doc, start, ids, total, self.size - free))
        if free == n:
            return out + self.emit(w)
        insort(self.room, (free - n, w))
        return out

    def emit(self, w: int) -> list[tuple]:
        return [
            (doc, start, len(ids) // 4, zlib.crc32(ids), total, w, offset, None)
            for doc, start, ids, total, offset in self.held.pop(w)
        ]

    def leftovers(self) -> list[tuple]:
        """Pieces of the windows still open, without a place, with their ids."""
        return [
            (doc, start, len(ids) // 4, None, total, None, None, ids)
            for w in sorted(self.held)
            for doc, start, ids, total, _ in self.held[w]
        ]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


_ARROW = pa.schema(
    [(p.split()[0], pa.binary() if p.endswith("binary") else pa.int64()) for p in PIECES.split(", ")]
)


def _packer(path: str, window: int, most: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, windows = shared_tokens(path, END_ID), Windows(TaskContext.get().partitionId() << 32, window, most)
        for batch in batches:
            rows, docs = [], batch.column(0).to_pylist()
            ids, begins = tokens.encode(batch.column(1))
            raw, begins = ids.astype("<u4", copy=False).tobytes(), begins.tolist()
            for doc, at, end in zip(docs, begins, begins[1:], strict=False):
                for start in range(at, end, window):
                    piece = raw[4 * start : 4 * min(start + window, end)]
                    rows += windows.place(doc, start - at, piece, end - at)
            if rows:
                yield _batch(rows, _ARROW)
        if rest := windows.leftovers():
            yield _batch(rest, _ARROW)

    return pack


def _pourer(window: int):
    """One group of leftovers into full windows, cutting where a window ends; ids keep high sequence numbers."""

    def pour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, offset = (1 << 62) + (TaskContext.get().partitionId() << 32), 0
        for batch in batches:
            rows = []
            for doc, start, ids, total in zip(*(batch.column(c).to_pylist() for c in ("doc", "start", "ids", "doc_tokens")), strict=True):
                at, n = 0, len(ids) // 4
                while at < n:
                    take = min(n - at, window - offset)
                    cut = ids[4 * at : 4 * (at + take)]
                    rows.append((doc, start + at, take, zlib.crc32(cut), total, sequence, offset, None))
                    at, offset = at + take, offset + take
                    if offset == window:
                        sequence, offset = sequence + 1, 0
            if rows:
                yield _batch(rows, _ARROW)

    return pour


def packed(documents: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", window: int = WINDOW, most: int = OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; repeated rows and null ids are packed like any others; extra
    columns are not read; an empty table gives no pieces.  Sequence ids are unique, not dense."""
    spark = documents.sparkSession
    small_batches(spark, size=4 << 20)
    slim = documents.select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    placed = stored(slim.mapInArrow(_packer(tokenizer, window, most), PIECES), "packed")
    rest = placed.where("sequence_id IS NULL")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    groups = -(-tokens // (GROUP_WINDOWS * window)) or 1
    poured = rest.repartition(groups).mapInArrow(_pourer(window), PIECES)
    done = placed.where("sequence_id IS NOT NULL").unionByName(poured)
    return done.select(F.col("doc").alias("doc_id"), *[p.split()[0] for p in PIECES.split(", ")[1:-1]])
