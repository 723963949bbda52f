"""Nested read models in bounded pages, reports with subtotals, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import Position, Sequence

PAGE_ROWS = 1000


def nest_pages(
    children: DataFrame, parent: list[str], position: str, fields: list[str], name: str, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Children as ordered arrays, one row per parent and page.

    Children are ordered by `position`, those that share one by their fields.  A page holds
    `page_rows` of them at most, counted and not by value, so an enormous parent spreads over many rows
    and never has to fit one task; a normal parent has the single page 0.
    """
    row = F.struct(position, *[f for f in fields if f != position])
    slim = children.select(*parent, row.alias("_row")).withColumn("_position", F.col("_row").getField(position))
    placed = Sequence(parent, ["_position", "_row"], []).apply(slim, _place=Position())
    page = F.floor((F.col("_place") - 1) / page_rows).alias("page")
    return (
        placed.select(*parent, page, "_row")
        .groupBy(*parent, "page")
        .agg(F.array_sort(F.collect_list("_row")).alias(name))
    )


def subtotals(df: DataFrame, dims: list[str], measures: list[Column], kind: str = "rollup") -> DataFrame:
    """ROLLUP or CUBE with a `level` column (grouping id); '(all)' marks a total."""
    grouped = df.rollup(*dims) if kind == "rollup" else df.cube(*dims)
    out = grouped.agg(*measures, F.grouping_id().cast("bigint").alias("level"))
    for i, d in enumerate(dims):
        bit = len(dims) - 1 - i
        is_total = F.col("level").bitwiseAND(F.lit(1 << bit)) > 0
        out = out.withColumn(d, F.when(is_total, F.lit("(all)")).otherwise(F.col(d).cast("string")))
    return out
