"""Best row per key, matching and set operators built on aggregates and joins.

Nothing here opens a window over a business key: the best row of a key is a
`max_by`, which combines on the map side, so a key that holds a third of all
rows costs one partial result per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """The whole row with the greatest rank per key (rank must be total)."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)])).alias("_best")
    )
    return best.select(*keys, "_best.*").select(*df.columns)


def flag_exists(left: DataFrame, right: DataFrame, on: list[str], flag: str) -> DataFrame:
    """1 where the key occurs on the right, else 0."""
    present = right.select(*on).distinct().withColumn(flag, F.lit(1))
    return left.join(present, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def absent(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on, "left_anti")


def keep_referenced(child: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """Child rows whose parent survives (cascade delete)."""
    return child.join(parents.select(*on).distinct(), on, "left_semi")


def insert_if_absent(base: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    return base.unionByName(absent(new, base, on), allowMissingColumns=True)


def carry_forward_column(new: DataFrame, old: DataFrame, on: list[str], column: str) -> DataFrame:
    """Keep `column` of the older snapshot where the newer one lacks it."""
    previous = old.where(F.col(column).isNotNull()).groupBy(*on).agg(F.min(column).alias("_old"))
    joined = new.join(previous, on, "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.col("_old"))).drop("_old")


def first_available(sources: list[DataFrame], on: list[str]) -> DataFrame:
    """Per key, one row from the earliest source that has the key: the greatest by its other columns, if there are several."""
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    others = [F.col(c) for c in every.columns if c not in (*on, "_source")]
    return best_per_key(every, on, [-F.col("_source"), *[F.to_json(F.struct(*others))]]).drop("_source")


def keep_or_all(df: DataFrame, group: list[str], keep: Column) -> DataFrame:
    """Filter, unless that would empty the group; then keep the whole group."""
    flagged = df.withColumn("_keep", keep)
    some = flagged.where("_keep").select(*group).distinct().withColumn("_some", F.lit(True))
    joined = flagged.join(some, group, "left")
    return joined.where(F.col("_keep") | F.col("_some").isNull()).drop("_keep", "_some")


def distinct_union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()
