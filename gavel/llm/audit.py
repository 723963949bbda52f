r"""What each quality filter removes, alone, in any order, and on average over all orders.

Every document gets the set of filters that it fails, as a bit mask.  Documents are counted by part and
mask, and from these counts alone follow the survivors of every subset of filters: a Gray-code walk
visits all subsets, switching one filter at a time.  Each mask cell has a counter of the active filters
that it fails; a cell whose counter leaves zero goes out of the running survivors, and one whose counter
comes back to zero returns.  The states of the walk are stored, and the effect of any step of any
order is the difference of two of them.

Filters (fixed values): A fewer than 200 words; B 100 * distinct words < 50 * words; C 100 * capitals A-Z
> 2 * code points; D any of `#$%&*|`; E the same text as a row with a smaller id.

Scale: texts are read once, in Arrow batches, and leave them as a digest and a few bits.  Counts combine
before each shuffle, so neither a part with a third of all rows nor a text copied as often
meets in one task: the rows that pass E are found as (digest, least id), an equi-join on both columns.
What is walked is one small matrix per part.

Cases: a null text is empty, and so is a null part; a null id is smaller than none and larger than none, so
its row passes E; repeated rows each count, and those with the least id of their text all pass E; a document
counts as labelled if any row of `labels` with its id says so; columns beyond those named are not read;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import as_bytes, small_batches
from gavel.session import stored

#: Fixed values of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PER_CENT = 50
MAX_CAPITALS_PER_CENT = 2
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))

FILTERS = "ABCDE"
SAME_TEXT = 1 << FILTERS.index("E")
STATE = ("kept", "good", "toxic")


def failures(data: bytes) -> int:
    """Bits of the filters A to D that one text fails."""
    words = data.split()  # bytes split at the six ASCII blanks, and only there
    points = len(data.translate(None, CONTINUATION))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PER_CENT * len(words),
        100 * capitals > MAX_CAPITALS_PER_CENT * points,
        SYMBOLS.search(data) is not None,
    )
    return sum(bit << k for k, bit in enumerate(failed))


def _failed(texts: pd.Series) -> pd.Series:
    return pd.Series([failures(bytes(t or b"")) for t in texts], dtype="int32")


def failed_mask(text: Column) -> Column:
    """`failures` of a text column."""
    return F.pandas_udf(_failed, "int")(as_bytes(F.coalesce(text, F.lit(""))))


def labelled(labels: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, good, toxic: one row for each labelled id."""
    return labels.groupBy(F.col(doc).alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )


def masks(documents: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask, kept, good, toxic: the documents of each part by the exact set of filters that they fail."""
    small_batches(documents.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    slim = documents.select(
        F.col(doc).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.sha2(as_bytes(body), 256).alias("sha"),
        failed_mask(F.col(text)).alias("mask"),
    )
    slim = stored(slim, "masks")
    first = slim.groupBy("sha").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    counted = slim.groupBy("sha", "id", "part", "mask").count()
    known = labelled(labels, doc)
    rows = counted.join(first, ["sha", "id"], "left").join(known, F.col("id") == F.col("label_id"), "left")
    copied = F.col("first").isNull() & F.col("id").isNotNull()
    whole = F.col("mask") + F.when(copied, SAME_TEXT).otherwise(0)
    said = [F.sum(F.col("count") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", whole.alias("mask")).agg(F.sum("count").alias("kept"), *said)


def walked(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, from counts by failed mask.

    `cells` is (..., 2**n, k): k counts for each mask; the result has the same shape, by subset of active filters."""
    size = cells.shape[-2]
    masks_, states = np.arange(size), np.empty_like(cells)
    counter, active, alive = np.zeros(size, np.int64), 0, cells.sum(axis=-2)
    states[..., 0, :] = alive
    for step in range(1, size):
        bit = step & -step  # the filter that a reflected Gray code switches at this step
        active ^= bit
        hit = masks_ & bit != 0
        if active & bit:
            alive = alive - cells[..., hit & (counter == 0), :].sum(axis=-2)
            counter[hit] += 1
        else:
            counter[hit] -= 1
            alive = alive + cells[..., hit & (counter == 0), :].sum(axis=-2)
        states[..., active, :] = alive
    return states


def _orders(filters: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders, and for every (order, step) the subset active before it and the bit of its filter."""
    orders = ["".join(p) for p in permutations(filters)]
    bits = np.array([[1 << filters.index(f) for f in order] for order in orders])
    return orders, np.cumsum(bits, axis=1) - bits, bits


STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _stepper(filters: str):
    size = 1 << len(filters)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, before, bits = _orders(filters)
        for batch in batches:
            parts = batch.column("part").to_pylist()
            for part, cells in zip(parts, batch.column("cells").to_pylist(), strict=True):
                counts = np.zeros((size, len(STATE)), np.int64)
                for c in cells:
                    counts[c["mask"]] = [c[s] for s in STATE]
                states = walked(counts)
                lost = states[before] - states[before | bits]
                removed = lost[..., 0]
                fails = {1 << k: counts[np.arange(size) >> k & 1 == 1, 0].sum() for k in range(len(filters))}
                failing = np.vectorize(fails.__getitem__, otypes=[np.int64])(bits)
                share = {1 << k: removed[bits == 1 << k].sum() for k in range(len(filters))}
                shapley = np.vectorize(share.__getitem__, otypes=[np.int64])(bits)
                columns = (
                    states[before | bits][..., 0],
                    removed,
                    failing - removed,
                    counts[bits, 0],
                    lost[..., 1],
                    lost[..., 2],
                    shapley,
                )
                rows = len(orders) * len(filters)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * rows, pa.string()),
                        pa.array(np.repeat(orders, len(filters)), pa.string()),
                        pa.array(np.tile(np.arange(1, len(filters) + 1), len(orders)), pa.int32()),
                        *[pa.array(c.ravel(), pa.int64()) for c in columns],
                    ],
                    names=[c.split()[0] for c in STEPS.split(", ")],
                )

    return steps


def interactions(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step: what is kept after it and lost at it.

    `counted` is as `masks` gives it, bit k of a mask standing for filter k; any filters will do."""
    cell = F.struct("mask", *STATE)
    one = counted.groupBy("part").agg(F.collect_list(cell).alias("cells"))  # at most one cell per mask
    return one.mapInArrow(_stepper(filters), STEPS)


def audited(documents: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """`interactions` of the five filters over whole tables."""
    return interactions(masks(documents, labels, doc, text, part))
