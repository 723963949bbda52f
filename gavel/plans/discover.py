"""What is published but not processed yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import absent, best_per_key


def match_index(index: DataFrame, meetings: DataFrame) -> DataFrame:
    """Every index row with its meeting, if any, and whether that already has a transcript."""
    m = best_per_key(
        meetings.select("date", "meeting_type", F.col("id").alias("agenda_id"), "item_count", "transcript_source_id"),
        ["date", "meeting_type"],
        [F.col("item_count"), -F.col("agenda_id")],
    )
    joined = index.join(m.drop("item_count"), ["date", "meeting_type"], "left")
    return joined.withColumn("already_matched", F.col("transcript_source_id").isNotNull()).drop("transcript_source_id")


def unprocessed(matched: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Not in the processed ids and not matched; `processable` where an agenda exists."""
    left = absent(matched.where(~F.col("already_matched")), processed, [key])
    return left.withColumn("processable", F.col("agenda_id").isNotNull())


def health(matched: DataFrame, todo: DataFrame) -> DataFrame:
    """Index / matched / to do / processable counts as one row."""
    one = lambda c: F.count(F.when(c, 1))
    index = matched.select(F.lit("index").alias("part"), F.col("agenda_id").isNotNull().alias("agenda"), F.col("already_matched").alias("flag"))
    rest = todo.select(F.lit("todo").alias("part"), F.col("agenda_id").isNotNull().alias("agenda"), F.col("processable").alias("flag"))
    in_index, in_todo = F.col("part") == "index", F.col("part") == "todo"
    return index.unionByName(rest).agg(
        one(in_index).alias("indexed"),
        one(in_index & F.col("agenda")).alias("with_agenda"),
        one(in_index & F.col("flag")).alias("done"),
        one(in_todo).alias("unprocessed"),
        one(in_todo & F.col("flag")).alias("processable"),
    )


def ids_between(meetings: DataFrame, date: str, start: str, end: str, ident: str) -> DataFrame:
    """Distinct ids in [start, end)."""
    # literals take the column's own type, so the comparison is pushed to the scan
    kind = meetings.schema[date].dataType
    d = F.col(date)
    return meetings.where((d >= F.lit(start).cast(kind)) & (d < F.lit(end).cast(kind))).select(ident).distinct()
