"""Ordered computations inside a group that stay balanced when one group is huge.

A plain `Window.partitionBy(meeting)` sends a whole meeting to one task.  That is
right while every meeting fits one, so the largest group is counted first (a
map-side combined count).  If it is within `target_rows`, a plain window is used.
If not, the rows are cut into consecutive ranges of the whole order; the window runs per
group and range, a summary with one row per chunk carries state across the cuts, and the two are
joined on the range.  The cut rows are written to the checkpoint folder once, as
both sides read them.

    seq = Sequence(keys=["meeting_id"], order=["sec", "idx"], ordinals=["sec", "idx"])
    seq.apply(df, prev=Prev("sec"), turn=Running(F.col("is_start")))

`seq.sized(df)` makes the count once; the result may be applied to `df` and to
anything that has no more rows per group than `df`.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

TARGET_ROWS = 1_000_000


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class Prev:
    """Value on the physically previous row (lag 1)."""

    value: str | Column

    def plain(self, w):
        return F.lag(_col(self.value)).over(w)

    def inner(self, w):
        return F.lag(F.struct(_col(self.value).alias("v"))).over(w)

    def edge(self, order):
        return F.max_by(F.struct(_col(self.value).alias("v")), order)

    def across(self, edge, w):
        return F.lag(edge).over(w)

    def combine(self, inner, outer):
        return F.coalesce(inner, outer)["v"]


@dataclass(frozen=True)
class Next:
    """Value on the physically next row (lead 1)."""

    value: str | Column

    def plain(self, w):
        return F.lead(_col(self.value)).over(w)

    def inner(self, w):
        return F.lead(F.struct(_col(self.value).alias("v"))).over(w)

    def edge(self, order):
        return F.min_by(F.struct(_col(self.value).alias("v")), order)

    def across(self, edge, w):
        return F.lead(edge).over(w)

    def combine(self, inner, outer):
        return F.coalesce(inner, outer)["v"]


@dataclass(frozen=True)
class Carry:
    """Last non-null value so far; `before=True` leaves the current row out."""

    value: str | Column
    before: bool = False

    def plain(self, w):
        return self.inner(w)

    def inner(self, w):
        last = -1 if self.before else 0
        return F.last(_col(self.value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, last))

    def edge(self, order):
        v = _col(self.value)
        return F.max_by(v, F.when(v.isNotNull(), order))

    def across(self, edge, w):
        return F.last(edge, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))

    def combine(self, inner, outer):
        return F.coalesce(inner, outer)


@dataclass(frozen=True)
class Running:
    """Running sum including the current row."""

    value: str | Column

    def plain(self, w):
        return self.inner(w)

    def inner(self, w):
        return F.sum(_col(self.value)).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def edge(self, order):
        return F.sum(_col(self.value))

    def across(self, edge, w):
        return F.sum(edge).over(w.rowsBetween(Window.unboundedPreceding, -1))

    def combine(self, inner, outer):
        return F.when(inner.isNotNull() | outer.isNotNull(), F.coalesce(inner, F.lit(0)) + F.coalesce(outer, F.lit(0)))


def Position() -> Running:
    """1-based position in the group."""
    return Running(F.lit(1).cast("bigint"))


@dataclass(frozen=True)
class RunningMax:
    """Running maximum including the current row (nulls skipped)."""

    value: str | Column

    def plain(self, w):
        return self.inner(w)

    def inner(self, w):
        return F.max(_col(self.value)).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def edge(self, order):
        return F.max(_col(self.value))

    def across(self, edge, w):
        return F.max(edge).over(w.rowsBetween(Window.unboundedPreceding, -1))

    def combine(self, inner, outer):
        return F.greatest(inner, outer)


@dataclass(frozen=True)
class First:
    """Value on the first row of the whole group, null or not."""

    value: str | Column

    def plain(self, w):
        return F.first(_col(self.value)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def inner(self, w):
        return F.lit(None).cast("boolean")

    def edge(self, order):
        return F.min_by(F.struct(_col(self.value).alias("v")), order)

    def across(self, edge, w):
        return F.first(edge).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def combine(self, inner, outer):
        return outer["v"]


@dataclass(frozen=True)
class Lowest:
    """Minimum over the whole group, on every row."""

    value: str | Column

    def plain(self, w):
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return F.min(_col(self.value)).over(whole)

    def inner(self, w):
        return F.lit(None).cast("boolean")

    def edge(self, order):
        return F.min(_col(self.value))

    def across(self, edge, w):
        return F.min(edge).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def combine(self, inner, outer):
        return outer


@dataclass(frozen=True)
class Total:
    """Sum over the whole group, on every row."""

    value: str | Column

    def plain(self, w):
        return F.sum(_col(self.value)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def inner(self, w):
        return F.lit(None).cast("boolean")

    def edge(self, order):
        return F.sum(_col(self.value))

    def across(self, edge, w):
        return F.sum(edge).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def combine(self, inner, outer):
        return outer


def chunked(df: DataFrame, keys: list[str], order: list[str | Column], target_rows: int = TARGET_ROWS) -> DataFrame:
    """`df` in ranges of (keys, order), stored, with the number of its range as `_chunk`.

    Ranges are cut from a sample of the rows and follow the whole order, so a group of any size is cut into
    consecutive pieces, whatever its values are and however many rows share the first of them."""
    total = df.count()
    ranges = max(1, -(-total // target_rows)) * 2
    cut = df.repartitionByRange(ranges, *keys, *[_col(o) for o in order])
    return cut_lineage(cut.withColumn("_chunk", F.spark_partition_id()))


@dataclass(frozen=True)
class Sequence:
    """Rows of one group in a total order.

    keys      group columns (no nulls); may be empty for one global sequence
    order     sort expressions or names that make the order total
    ordinals  numeric columns that follow the order (callers state them; cutting needs the order alone)
    """

    keys: list[str]
    order: list[str | Column]
    ordinals: list[str] = field(default_factory=list)
    target_rows: int = TARGET_ROWS
    fits: bool | None = None

    def sized(self, df: DataFrame) -> Sequence:
        """This sequence with the largest group of `df` counted."""
        largest = df.groupBy(*self.keys).count().agg(F.max("count")).first()[0] or 0
        return replace(self, fits=largest <= self.target_rows)

    def apply(self, df: DataFrame, **ops) -> DataFrame:
        """Add one column per op; `df` columns are kept."""
        fits = self.fits if self.fits is not None else self.sized(df).fits
        return self._plain(df, ops) if fits else self._cut(df, ops)

    def _plain(self, df: DataFrame, ops: dict) -> DataFrame:
        w = Window.partitionBy(*self.keys).orderBy(*[_col(o) for o in self.order])
        return df.select("*", *[op.plain(w).alias(n) for n, op in ops.items()])

    def _cut(self, df: DataFrame, ops: dict) -> DataFrame:
        order = [_col(o) for o in self.order]
        keys = list(self.keys)
        if not keys:
            df = df.withColumn("_all", F.lit(0))
            keys = ["_all"]
        cut, chunks = chunked(df, keys, self.order, self.target_rows), ["_chunk"]
        by = keys + chunks
        inner = Window.partitionBy(*by).orderBy(*order)
        across = Window.partitionBy(*keys).orderBy(*chunks)
        rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])

        edges = cut.groupBy(*by).agg(*[op.edge(rank).alias(f"_e_{n}") for n, op in ops.items()])
        edges = edges.select(*by, *[op.across(F.col(f"_e_{n}"), across).alias(f"_a_{n}") for n, op in ops.items()])

        rows = cut.select("*", *[op.inner(inner).alias(f"_i_{n}") for n, op in ops.items()])
        joined = rows.join(edges, by)
        for n, op in ops.items():
            joined = joined.withColumn(n, op.combine(F.col(f"_i_{n}"), F.col(f"_a_{n}")))
        drop = [f"_i_{n}" for n in ops] + [f"_a_{n}" for n in ops] + chunks
        return joined.drop(*drop, "_all")
