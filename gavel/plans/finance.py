"""Money: mentions in texts, one entry per amount, totals per item and meeting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import ColumnLike, col, indexes, let, lines_of
from ..functions.money import MONEY, amount_label, amount_value, amounts_in, entry_type, section_of_line, signed_value
from ..functions.rules import is_second_part


def summary_lines(text: ColumnLike, strict_reference: bool = False) -> Column:
    """Lines of a summary sheet that hold amounts: (line_no, section, context, amounts).

    Row-local: the section of a line is the last header at or before it, and the
    line above joins the context unless it has an amount of its own.
    """

    def read(lines, headers):
        def one(i):
            line, above = F.get(lines, i), F.get(lines, i - 1)
            shown = F.when((i > 0) & ~above.rlike(r"\$\d"), above)
            return F.struct(
                i.alias("line_no"),
                F.try_element_at(F.filter(headers, lambda h: h["i"] <= i), F.lit(-1))["s"].alias("section"),
                F.concat_ws(" ", line, shown).alias("context"),
                amounts_in(line, strict_reference).alias("amounts"),
            )

        return F.transform(_with_money(lines), one)

    def headers_of(lines):
        marked = F.transform(lines, lambda x, i: F.struct(i.alias("i"), section_of_line(x).alias("s")))
        return F.filter(marked, lambda h: h["s"].isNotNull())

    # white space inside lines is squashed in the whole text, at once
    squashed = F.regexp_replace(col(text), r"[\s\u00A0&&[^\n]]+", " ")
    return let(lines_of(squashed), lambda lines: let(headers_of(lines), lambda hs: read(lines, hs)))


def _with_money(lines: Column) -> Column:
    """Indexes of the lines that hold an amount."""
    return F.filter(indexes(lines), lambda i: F.get(lines, i).rlike(r"\$\d"))


def block_lines(text: ColumnLike, strict_reference: bool = False) -> Column:
    """Lines of any other text that hold amounts, with the line above as context."""

    def read(lines):
        def one(i):
            line = F.get(lines, i)
            return F.struct(
                i.alias("line_no"),
                F.lit(None).cast("string").alias("section"),
                F.concat_ws(" ", F.when(i > 0, F.get(lines, i - 1)), line).alias("context"),
                amounts_in(line, strict_reference).alias("amounts"),
            )

        return F.transform(_with_money(lines), one)

    return let(lines_of(text), read)


def mentions(df: DataFrame, keys: list[str], text: str, source: str, rank: int, strict_reference: bool = False) -> DataFrame:
    """One row per amount mention; source 'summary' is read by section."""
    is_summary = source == "summary"
    found = summary_lines(text, strict_reference) if is_summary else block_lines(text, strict_reference)
    rows = df.select(*keys, F.explode(found).alias("e"))
    rows = rows.select(*keys, "e.*").select(
        *keys, "line_no", "section", "context", F.posexplode("amounts").alias("amount_no", "raw")
    )
    return rows.select(
        *keys,
        F.lit(rank).alias("source_rank"),
        F.lit(source).alias("source"),
        "line_no",
        "amount_no",
        amount_label("raw").alias("amount"),
        amount_value("raw").alias("value"),
        entry_type("context", "section").alias("type"),
        "section",
        "context",
    )


def consolidate(found: DataFrame, keys: list[str], contexts: bool = True) -> DataFrame:
    """One row per item and amount string, mentions taken in reading order.

    The first typed mention sets the type.  Later mentions of another type change it
    only when their wording is definite.  As types come from the wording, a mention
    is one of: definite (an "expenditure decrease", or a plain expenditure), leaning
    ("(expenditure)" next to revenue or credit words, which moves any other type
    than its own to expenditure), or without effect.  The result is therefore the
    last definite type, or else the first one, moved to expenditure by a leaning
    mention after it: four ordered aggregates, combined before the shuffle.
    """
    text = F.lower("context")
    kind = F.col("type")
    typed = kind != "unspecified"
    cut = text.contains("decrease")
    definite = (
        F.when(text.contains("expenditure decrease"), "expenditure_decrease")
        .when((kind == "expenditure") & ~cut, "expenditure")
    )
    leaning = text.contains("(expenditure)") & ~cut
    rows = found.withColumn("_seq", F.struct("source_rank", "line_no", "amount_no")).select(
        "*", definite.alias("_definite"), (leaning & (kind == "revenue")).alias("_from_cut"),
        (leaning & (kind == "expenditure_decrease")).alias("_from_revenue"),
    )
    at = lambda c: F.when(c, F.col("_seq"))
    is_definite = F.col("_definite").isNotNull()
    every = [
        F.max_by("value", "_seq").alias("value"),
        F.min_by("section", at(F.col("section").isNotNull())).alias("section"),
        F.count(F.lit(1)).alias("mentions"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.max_by("_definite", at(is_definite)).alias("_last"),
        F.max(at(is_definite)).alias("_last_at"),
        F.min_by("type", at(typed)).alias("_first"),
        F.min(at(typed)).alias("_first_at"),
        F.max(at(F.col("_from_cut"))).alias("_cut_at"),
        F.max(at(F.col("_from_revenue"))).alias("_revenue_at"),
    ]
    if contexts:  # the texts of one item bound this list
        every.append(F.array_sort(F.collect_list(F.struct("_seq", "context"))).alias("_contexts"))
    out = rows.groupBy(*keys, "amount").agg(*every)
    base, since = F.coalesce("_last", "_first", F.lit("unspecified")), F.coalesce("_last_at", "_first_at")
    moved = ((base == "expenditure_decrease") & (F.col("_cut_at") > since)) | (
        (base == "revenue") & (F.col("_revenue_at") > since)
    )
    settled = F.when(F.coalesce(moved, F.lit(False)), "expenditure").otherwise(base)
    listed = [F.transform("_contexts", lambda m: m["context"]).alias("contexts")] if contexts else []
    return out.select(
        *keys, "amount", "value", settled.alias("type"), "section", "mentions", "sources", *listed
    ).withColumn("signed_value", signed_value("type", "value"))


def item_totals(details: DataFrame, keys: list[str]) -> DataFrame:
    """Totals per item by entry type; net = expenditures − decreases − revenues."""
    part = lambda *kinds: F.coalesce(F.sum(F.when(F.col("type").isin(*kinds), F.col("value"))), F.lit(0).cast(MONEY))
    known = ("expenditure", "expenditure_decrease", "revenue")
    return details.groupBy(*keys).agg(
        part("expenditure").alias("expenditures"),
        part("expenditure_decrease").alias("decreases"),
        part("revenue").alias("revenues"),
        F.coalesce(F.sum(F.when(~F.col("type").isin(*known), F.col("value"))), F.lit(0).cast(MONEY)).alias("other"),
        F.coalesce(F.sum("signed_value"), F.lit(0).cast(MONEY)).alias("net"),
    )


def item_figures(details: DataFrame, keys: list[str]) -> DataFrame:
    """Per item: its largest amount, and its expenditure.

    The expenditure is the largest fiscal-impact amount; failing that the sum of
    the projected costs; failing that the largest expenditure.
    """
    spent = F.col("type") == "expenditure"
    fiscal = F.max(F.when(spent & (F.col("section") == "fiscal_impact"), F.col("value")))
    projected = F.sum(F.when(spent & (F.col("section") == "projected_costs"), F.col("value")))
    anything = F.max(F.when(spent, F.col("value")))
    return details.groupBy(*keys).agg(
        F.max("value").alias("amount"), F.coalesce(fiscal, projected, anything).alias("expenditure")
    )


def meeting_summary(figures: DataFrame, meeting: str, item: str, title: str | None = None) -> DataFrame:
    """Per meeting: total discussed, range, expenditure total and range.

    Second parts are left out, as they repeat the money of part one.  Equal amounts
    resolve to the lowest item number for the smallest and the highest for the largest.
    """
    df = figures.where(~is_second_part(title)) if title else figures
    amount = F.when(F.col("amount") > 0, F.col("amount"))
    spent = F.when(F.col("expenditure") > 0, F.col("expenditure"))
    order = lambda v: F.when(v.isNotNull(), F.struct(v, F.col(item)))
    zero = F.lit(0).cast(MONEY)
    return df.groupBy(meeting).agg(
        F.coalesce(F.sum(amount), zero).alias("total_discussed"),
        F.count(amount).alias("item_count"),
        F.min(amount).alias("smallest_amount"),
        F.min_by(item, order(amount)).alias("smallest_item"),
        F.max(amount).alias("largest_amount"),
        F.max_by(item, order(amount)).alias("largest_item"),
        F.coalesce(F.sum(spent), zero).alias("total_expenditures"),
        F.count(spent).alias("expenditure_items"),
        F.min(spent).alias("smallest_expenditure"),
        F.max(spent).alias("largest_expenditure"),
    )


def from_item_texts(items: DataFrame, keys: list[str], texts: list[tuple[str, str]], strict_reference: bool = False) -> DataFrame:
    """Details of items whose texts are columns: (column, source) in reading order."""
    parts = [mentions(items, keys, c, s, i, strict_reference) for i, (c, s) in enumerate(texts)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return consolidate(every, keys)
