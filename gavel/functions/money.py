"""Dollar amounts in text: finding, valuing, typing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, col

# The historic pattern cuts '$1234' to '$123'; the default one does not.
AMOUNT_STRICT = r"(?i)\$\d+(?:\.\d+)?\s*(?:million|billion|trillion)|\$\d{1,3}(?:,\d{3})*(?:\.\d{2})?"
AMOUNT = r"(?i)\$(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?(?:\s*(?:million|billion|trillion))?"
MAGNITUDES = (("million", 10**6), ("billion", 10**9), ("trillion", 10**12))
MONEY = "decimal(24,2)"


def amounts_in(text: ColumnLike, strict_reference: bool = False) -> Column:
    """Array of amount strings in reading order."""
    return F.regexp_extract_all(col(text), F.lit(AMOUNT_STRICT if strict_reference else AMOUNT), F.lit(0))


def amount_value(amount: ColumnLike) -> Column:
    """Value of an amount string; 0 when it has no number."""
    a = F.lower(col(amount))
    number = F.regexp_extract(F.regexp_replace(a, r"[$,]", ""), r"(\d+(?:\.\d+)?)", 1)
    base = F.coalesce(number.try_cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))
    scaled = F.lit(None)
    for word, factor in reversed(MAGNITUDES):
        scaled = F.when(a.contains(word), (base * F.lit(factor).cast("decimal(13,0)")).cast(MONEY)).otherwise(scaled)
    return F.coalesce(scaled, base.cast(MONEY))


def amount_label(amount: ColumnLike) -> Column:
    """Spoken magnitudes are written out ('$9.4 million' -> '$9,400,000.00')."""
    spoken = F.lower(col(amount)).rlike("million|billion|trillion")
    return F.when(spoken, F.concat(F.lit("$"), F.format_number(amount_value(amount), 2))).otherwise(col(amount))


# Wording of each entry type, tried in this order.
DECREASE_WORDS = "decrease|deduct|credit"
REVENUE_WORDS = "revenue|income|reimbursement"
EXPENDITURE_WORDS = "expenditure|expense|payment|appropriation"


def entry_type(context: ColumnLike, section: ColumnLike | None = None) -> Column:
    c = F.lower(F.coalesce(col(context), F.lit("")))
    projected = F.coalesce((col(section) if section is not None else F.lit("")) == "projected_costs", F.lit(False))
    return (
        F.when((c == "") & projected, "expenditure")
        .when(c.rlike(DECREASE_WORDS), "expenditure_decrease")
        .when(c.rlike(REVENUE_WORDS), "revenue")
        .when(c.rlike(EXPENDITURE_WORDS) | projected, "expenditure")
        .otherwise("unspecified")
    )


def signed_value(kind: ColumnLike, value: ColumnLike) -> Column:
    k, v = col(kind), col(value)
    zero = F.lit(0).cast(MONEY)
    return F.when(k == "expenditure", v).when(k.isin("expenditure_decrease", "revenue"), -v).otherwise(zero)


def section_of_line(line: ColumnLike) -> Column:
    """Section that a summary-sheet line opens, null for any other line."""
    u = F.upper(col(line))
    return F.when(u.startswith("FISCAL IMPACT"), "fiscal_impact").when(u.startswith("PROJECTED COSTS"), "projected_costs")
