"""Greedy anchored clustering on a line.

Sorted values join the open cluster while they lie within `width` of its first
value (the anchor), so it is not a session window.  A gap wider than `width`
always opens a cluster, whatever came before, so the values are first cut into
runs at such gaps (a balanced sequence job).  A run of ordinary length is folded
as a native array aggregate.  A run too long for that is solved by pointer
doubling: every value knows the value that would open the next cluster after it,
and following those pointers 1, 2, 4, … steps at a time marks all anchors in a
logarithmic number of joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sequence import Carry, Prev, Running, Sequence


def _opens(x: Column, anchor: Column, width: float, inclusive: bool) -> Column:
    return x > anchor + width if inclusive else x >= anchor + width


def anchored_starts(values: Column, width: float, inclusive: bool = True) -> Column:
    """Anchors of a sorted array of doubles."""

    def step(starts, x):
        last = F.get(starts, F.size(starts) - 1)
        opens = last.isNull() | _opens(x, last, width, inclusive)
        return F.when(opens, F.concat(starts, F.array(x))).otherwise(starts)

    return F.aggregate(values, F.array().cast("array<double>"), step)


def _anchors_by_doubling(points: DataFrame, by: list[str], width: float, inclusive: bool, target_rows: int) -> DataFrame:
    """Anchors of long runs.  points: by, _x (distinct values)."""
    # walking down from large values, the last point seen is the next one above
    first_side = (1, 0) if inclusive else (0, 1)  # at equal values: probe before point, or after
    above = points.select(*by, (-F.col("_x")).alias("_n"), F.lit(first_side[0]).alias("_side"), F.col("_x").alias("_point"))
    probes = points.select(*by, (-(F.col("_x") + width)).alias("_n"), F.lit(first_side[1]).alias("_side"), F.col("_x").alias("_from"))
    both = above.unionByName(probes, allowMissingColumns=True)
    seen = Sequence(by, ["_n", "_side"], ["_n", "_side"], target_rows).apply(both, _to=Carry("_point"))
    jump = cut_lineage(seen.where(F.col("_from").isNotNull()).select(*by, F.col("_from").alias("_x"), "_to"))
    marked = points.groupBy(*by).agg(F.min("_x").alias("_x"))
    while True:
        reached = marked.join(jump, [*by, "_x"]).where(F.col("_to").isNotNull()).select(*by, F.col("_to").alias("_x"))
        reached = cut_lineage(reached)
        if reached.isEmpty():
            return marked
        marked = cut_lineage(marked.unionByName(reached).distinct())
        further = jump.select(*by, F.col("_x").alias("_to"), F.col("_to").alias("_next"))
        jump = cut_lineage(jump.join(further, [*by, "_to"]).select(*by, "_x", F.col("_next").alias("_to")))


def anchored_clusters(
    df: DataFrame, keys: list[str], value: str, width: float, inclusive: bool = True, target_rows: int = 1_000_000
) -> DataFrame:
    """Add `anchor`, the first value of the row's cluster."""
    points = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x")).distinct()
    seq = Sequence(keys, ["_x"], ["_x"], target_rows).sized(points)
    gaps = seq.apply(points, _prev=Prev("_x"))
    opens = F.col("_prev").isNull() | _opens(F.col("_x"), F.col("_prev"), width, inclusive)
    runs = seq.apply(gaps.withColumn("_new", opens.cast("bigint")), _run=Running("_new")).select(*keys, "_run", "_x")
    by = [*keys, "_run"]

    def folded(some: DataFrame) -> DataFrame:
        xs = some.groupBy(*by).agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
        return xs.select(*keys, F.explode(anchored_starts(F.col("_xs"), width, inclusive)).alias("_x"))

    if seq.fits:  # no key, hence no run, is above the target
        anchors = folded(runs)
    else:
        runs = cut_lineage(runs)
        # at most points/target_rows runs are this long
        long = F.broadcast(runs.groupBy(*by).count().where(F.col("count") > target_rows).select(*by))
        solved = _anchors_by_doubling(runs.join(long, by, "left_semi"), by, width, inclusive, target_rows)
        anchors = folded(runs.join(long, by, "left_anti")).unionByName(solved.select(*keys, "_x"))
    marked = points.join(anchors.withColumn("_anchor", F.col("_x")), [*keys, "_x"], "left")
    members = seq.apply(marked, anchor=Carry("_anchor")).select(*keys, "_x", "anchor")
    return df.withColumn("_x", F.col(value).cast("double")).join(members, [*keys, "_x"]).select(*df.columns, "anchor")
