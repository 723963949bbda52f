"""Points in intervals of any width, without nested loops.

Points are cut into consecutive ranges of their order.  An interval goes to every range that it touches: at most the
two in which it begins and ends without covering them, and each one that it covers, all of whose points it is joined to
anyway; so copies of intervals stay below their number plus the pairs found.  A range and its intervals are swept
together: for each interval two binary searches in the sorted points.  Ranges hold a bounded number of points whatever the
keys and times are, so a day that holds a third of all points is many ranges; where many intervals meet in one range, they are dealt to
several sweeps of the same points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ranges import asof_backward

#: Points of one range, and intervals of one sweep: a sweep gives ten million pairs at most.
POINTS = 10_000
INTERVALS = 1_000


def _swept(left: pa.Table, right: pa.Table) -> pa.Table:
    """Pairs of some points (p, p_row) and some intervals (lo, hi, i_row)."""
    at, rows = left["p"].to_numpy(), left["p_row"].to_numpy()
    order = np.argsort(at, kind="stable")
    at, rows = at[order], rows[order]
    first = np.searchsorted(at, right["lo"].to_numpy(), "left")
    count = np.maximum(np.searchsorted(at, right["hi"].to_numpy(), "right") - first, 0)
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) + np.repeat(first - ends + count, count)
    return pa.table({"p_row": pa.array(rows[place], pa.int64()), "i_row": pa.array(np.repeat(right["i_row"].to_numpy(), count), pa.int64())})


def _keyed(df: DataFrame, keys: list[str]):
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    point_id: str,
    point_time: str,
    interval_id: str,
    start: str,
    end: str,
    target_points: int = POINTS,
    target_intervals: int = INTERVALS,
) -> DataFrame:
    """(point_id, interval_id) for all points with start <= time <= end under equal keys.

    Ids are long integers, unique in their table; times are whole numbers (dates and timestamps as days or microseconds).  Rows
    with a null time, bound or key match nothing, as do intervals that end before they start."""
    no_null = lambda df, cols: df.na.drop(subset=[*cols, *keys])
    p = no_null(points, [point_time]).select(_keyed(points, keys).alias("k"), F.col(point_time).cast("long").alias("p"), F.col(point_id).cast("long").alias("p_row"))
    i = no_null(intervals, [start, end]).where(F.col(start) <= F.col(end))
    i = i.select(_keyed(intervals, keys).alias("k"), F.col(start).cast("long").alias("lo"), F.col(end).cast("long").alias("hi"), F.col(interval_id).cast("long").alias("i_row"))

    ranges = max(1, -(-p.count() // target_points)) * 2
    cut = stored(p.repartitionByRange(ranges, "k", "p", "p_row").withColumn("chunk", F.spark_partition_id().cast("long")), "points")
    # a range may hold several keys; what an interval can touch is a part of it: one key in one range
    parts = cut.groupBy("k", "chunk").agg(F.min("p").alias("low"), (F.max("p") + 1).alias("after"))
    numbered = parts.withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy("chunk")).cast("long"))
    parts = stored(numbered, "parts")

    # the last part that begins at or before the end, and the last that ends before the start: what lies between is touched
    def last_part(rows: DataFrame, time: str, edge: str, name: str) -> DataFrame:
        found = asof_backward(rows, parts.select("k", edge, "nth", (-F.col("nth")).alias("tie")), ["k"], time, edge, "tie", fallback_first=False)
        return found.withColumn(name, F.col("match.nth")).drop("match")

    both = last_part(last_part(i, "hi", "low", "last"), "lo", "after", "before")
    places = F.sequence(F.coalesce("before", F.lit(0)) + 1, F.col("last"))
    touched = both.where(F.col("last") > F.coalesce("before", F.lit(0))).select("k", "lo", "hi", "i_row", F.explode(places).alias("nth"))
    dealt = stored(touched.join(parts.select("k", "nth", "chunk"), ["k", "nth"]), "touched")

    load = dealt.groupBy("k", "chunk").agg(F.count("*").alias("n"))
    slices = load.select("k", "chunk", F.ceil(F.col("n") / target_intervals).cast("int").alias("slices"))
    one = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    swept_points = cut.join(slices, ["k", "chunk"]).select("k", "chunk", one, "p", "p_row")
    slot = F.pmod(F.xxhash64("i_row"), F.col("slices")).cast("int").alias("slice")
    swept_intervals = dealt.join(slices, ["k", "chunk"]).select("k", "chunk", slot, "lo", "hi", "i_row")
    by = ["k", "chunk", "slice"]
    pairs = swept_points.groupBy(*by).cogroup(swept_intervals.groupBy(*by)).applyInArrow(_swept, "p_row long, i_row long")
    return pairs.select(F.col("p_row").alias(point_id), F.col("i_row").alias(interval_id))
