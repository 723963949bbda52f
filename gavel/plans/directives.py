"""Council directives to staff, counted by motion maker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import motion_maker


def directive_items(items: DataFrame, text: str, date: str, since: str) -> DataFrame:
    """Items since the cutoff that hold a directive and name a maker."""
    df = items.where((F.col(date) >= F.lit(since).cast("date")) & rules.is_directive(text))
    return df.withColumn("maker", motion_maker(text)).where(F.col("maker").isNotNull())


def tagged(
    items: DataFrame, maker: str, file_number: str, is_cra: Column, has_recurring_words: Column
) -> DataFrame:
    """Add is_cra, is_recurring and the maker's count per file number.

    The count covers all of the maker's items, excluded ones included.  It comes
    from a pre-aggregated table joined back, not from a window over the maker.
    """
    fn = F.coalesce(F.col(file_number), F.lit(""))
    df = items.withColumn("_fn", fn).withColumn("is_cra", F.coalesce(is_cra, F.lit(False)))
    counts = df.groupBy(maker, "_fn").agg(F.count(F.lit(1)).alias("appearances"))
    df = df.join(counts, [maker, "_fn"])
    recurring = ~F.col("is_cra") & F.coalesce(has_recurring_words, F.lit(False)) & (F.col("appearances") > 1)
    return df.withColumn("is_recurring", recurring).drop("_fn")


def tag_by_text(items: DataFrame, maker: str, file_number: str, text: str) -> DataFrame:
    cra = F.col(text).rlike("(?i)" + rules.CRA_PATTERN) | F.col(file_number).startswith("CRA")
    return tagged(items, maker, file_number, cra, F.col(text).rlike("(?i)" + rules.RECURRING_PATTERN))


def maker_counts(rows: DataFrame, maker: str, file_number: str) -> DataFrame:
    """Raw count, and adjusted: excluded items out, recurring file numbers once.

    Counted in two levels so that no distinct set of one maker meets in one task.
    """
    plain = ~F.col("is_cra") & ~F.col("is_recurring")
    per_file = rows.groupBy(maker, F.coalesce(F.col(file_number), F.lit("")).alias("_fn")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(plain, 1)).alias("one_time"),
        F.count(F.when(F.col("is_cra"), 1)).alias("excluded"),
        F.count(F.when(F.col("is_recurring"), 1)).alias("recurring_items"),
        F.max(F.col("is_recurring").cast("int")).alias("recurring"),
    )
    return per_file.groupBy(maker).agg(
        F.sum("n").alias("raw_count"),
        F.sum(F.col("one_time") + F.col("recurring")).alias("adjusted_count"),
        F.sum("one_time").alias("one_time"),
        F.sum("recurring_items").alias("recurring_items"),
        F.sum(F.col("recurring").cast("bigint")).alias("recurring_files"),
        F.sum("excluded").alias("excluded"),
    )


def sections(rows: DataFrame, maker: str, file_number: str, date: str) -> DataFrame:
    """Report rows: every one-time and excluded item, and recurring files once with their span."""
    section = F.when(F.col("is_cra"), "excluded").when(F.col("is_recurring"), "recurring").otherwise("one_time")
    tagged_rows = rows.withColumn("section", section)
    return tagged_rows.groupBy(maker, "section", file_number).agg(
        F.count(F.lit(1)).alias("appearances"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )


def first_of_each_file(rows: DataFrame, maker: str, file_number: str, date: str, tie: str) -> DataFrame:
    """The earliest item per maker and file number."""
    from ..operators.keyed import best_per_key

    return best_per_key(rows, [maker, file_number], [-F.unix_date(date), -F.col(tie)])


def markdown_rows(report: DataFrame, columns: list[str]) -> DataFrame:
    """Table rows as text, ready for `write.text`."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return report.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))
