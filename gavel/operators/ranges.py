"""As-of and interval joins without nested loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import Carry, Lowest, Sequence


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    tie: str,
    fallback_first: bool = True,
    target_rows: int = 1_000_000,
) -> DataFrame:
    """Each left row with the latest right row whose time is not after it.

    Among right rows at the same time the one with the lowest `tie` wins.  A left
    row before the first right row gets that first row when `fallback_first`.
    Both sides travel in one union, so there is one shuffle and no pair blow-up;
    the sequence operator cuts keys that are too large for a task.

    `left` columns are kept; the right row comes back as struct column `match`.
    """
    payload = [c for c in right.columns if c not in keys]
    lefts = left.select(
        *keys,
        F.col(left_time).cast("double").alias("_t"),
        F.lit(1).alias("_side"),
        F.lit(None).cast("double").alias("_tie"),
        F.struct(*[c for c in left.columns if c not in keys]).alias("_left"),
    )
    rights = right.where(F.col(right_time).isNotNull()).select(
        *keys,
        F.col(right_time).cast("double").alias("_t"),
        F.lit(0).alias("_side"),
        # descending tie: the lowest comes last and is the one carried
        (-F.col(tie)).cast("double").alias("_tie"),
        F.struct(*payload).alias("_right"),
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)
    seq = Sequence(keys, ["_t", "_side", "_tie"], ["_t", "_side"], target_rows)
    ops = {"_hit": Carry("_right")}
    if fallback_first:
        ops["_first"] = Lowest(F.when(F.col("_side") == 0, F.struct("_t", (-F.col("_tie")).alias("tie"), "_right")))
    out = seq.apply(both, **ops)
    out = out.where(F.col("_side") == 1)
    if fallback_first:
        out = out.withColumn("_hit", F.coalesce("_hit", "_first._right"))
    return out.select(*keys, "_left.*", F.col("_hit").alias("match"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_date: str,
    right_time: str,
    days_before: int,
    days_after: int,
    extra_keys: list[str] | None = None,
) -> DataFrame:
    """Pairs with right_time in [date - before 00:00, date + after 23:59:59.999].

    The left side is spread over the days of its interval (a fixed number), so the
    join is an equi-join on the day.  Intervals are whole days, so the day decides.
    """
    span = [F.date_add(F.col(left_date), i) for i in range(-days_before, days_after + 1)]
    spread = left.withColumn("_day", F.explode(F.array(*span)))
    dated = right.withColumn("_day", F.to_date(F.col(right_time)))
    return spread.join(dated, ["_day", *(extra_keys or [])]).drop("_day")
