"""Money queries over texts made from line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money
from ..operators.layout import spread_rows
from ..plans import finance
from .tables import table


def _cents(c):
    return F.col(c).cast("decimal(18,2)")


#: Rows of one task that makes a text of every row: tasks stay short however many rows there are.
PRICED_ROWS = 250_000


def _priced(spark, d):
    """Line items with prices as shown in text: $1,234.56."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus"
    )
    li = spread_rows(li, PRICED_ROWS)
    shown = F.concat(F.lit("$"), F.format_number(_cents("l_extendedprice"), 2))
    return li.withColumn("shown", shown).withColumn("price", _cents("l_extendedprice"))


PRICED = """
p AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, '$' || format('{:,.2f}', CAST(l_extendedprice AS DOUBLE)) AS shown FROM lineitem)
"""


def amounts_found(spark, d):
    """Amounts in a sentence with a grouped, a bare and a spoken amount, by both patterns."""
    p = _priced(spark, d)
    text = F.concat(
        F.lit("cost "), "shown", F.lit(" plus $"), F.col("l_partkey").cast("string"), F.lit(" and $"),
        F.col("l_linenumber").cast("string"), F.lit(".5 million"),
    )
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.array_join(money.amounts_in(text), "|").alias("amounts"),
        F.array_join(money.amounts_in(text, strict_reference=True), "|").alias("strict_amounts"),
    )


AMOUNTS_SQL = f"""
WITH {PRICED}, t AS (SELECT *, 'cost ' || shown || ' plus $' || l_partkey || ' and $' || l_linenumber || '.5 million' AS txt FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, shown || '|$' || l_partkey || '|$' || l_linenumber || '.5 million' AS amounts,
  array_to_string(regexp_extract_all(txt, '(?i)\\$\\d+(?:\\.\\d+)?\\s*(?:million|billion|trillion)|\\$\\d{{1,3}}(?:,\\d{{3}})*(?:\\.\\d{{2}})?', 0), '|') AS strict_amounts
FROM t
"""


def amount_values(spark, d):
    """Value and normal form of plain and spoken amounts."""
    p = _priced(spark, d)
    word = F.when(F.col("l_linenumber") % 3 == 0, " million").when(F.col("l_linenumber") % 3 == 1, " Billion").otherwise("")
    raw = F.when(word != "", F.concat(F.lit("$"), F.col("l_quantity").cast("int").cast("string"), F.lit(".4"), word)).otherwise(F.col("shown"))
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        money.amount_value(raw).cast("double").alias("value"), money.amount_label(raw).alias("label"),
    )


AMOUNT_VALUES_SQL = f"""
WITH {PRICED}, v AS (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN CAST((l_quantity + 0.4) * 10 AS BIGINT) * 100000
  WHEN 1 THEN CAST((l_quantity + 0.4) * 10 AS BIGINT) * 100000000 END AS big FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(coalesce(big, price) AS DOUBLE) AS value,
  CASE WHEN big IS NULL THEN shown ELSE '$' || format('{{:,.2f}}', CAST(big AS DOUBLE)) END AS label FROM v
"""


def entry_types(spark, d):
    """Entry type and signed value from context words and section."""
    p = _priced(spark, d)
    context = F.when(F.col("l_returnflag") == "A", "Decrease in appropriation").when(F.col("l_returnflag") == "N", "grant Revenue").when(F.col("l_linenumber") % 2 == 0, "payment due").otherwise("")
    section = F.when(F.col("l_linestatus") == "O", "projected_costs").otherwise("fiscal_impact")
    kind = money.entry_type(context, section)
    rows = p.select("l_orderkey", "price", kind.alias("type"))
    return rows.groupBy("type").agg(
        F.count(F.lit(1)).alias("entries"), F.sum(money.signed_value("type", "price")).cast("double").alias("signed_total")
    )


TYPES_SQL = f"""
WITH {PRICED}, k AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN 'expenditure_decrease' WHEN l_returnflag = 'N' THEN 'revenue'
  WHEN l_linenumber % 2 = 0 OR l_linestatus = 'O' THEN 'expenditure' ELSE 'unspecified' END AS type FROM p)
SELECT type, count(*) AS entries, CAST(sum(CASE type WHEN 'expenditure' THEN price WHEN 'unspecified' THEN 0 ELSE -price END) AS DOUBLE) AS signed_total FROM k GROUP BY 1
"""


def _sheets(spark, d):
    """One summary sheet per line item, in the layout of the fiscal sections."""
    p = _priced(spark, d)
    header = F.when(F.col("l_linestatus") == "O", "Projected Costs").otherwise("Fiscal Impact Statement:")
    kind = F.when(F.col("l_returnflag") == "A", "budget decrease").when(F.col("l_returnflag") == "N", "grant revenue").otherwise("contract payment")
    text = F.concat(
        F.lit("Background\nNo money here\n"), header, F.lit("\n  "), kind, F.lit("\n"), F.lit("Total "), "shown",
        F.lit(" for  year\nnext "), "shown", F.lit("\n"),
    )
    return p.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shown", "price", text.alias("text"))


def summary_entries(spark, d):
    """Entries of summary sheets with section, context and type."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = finance.mentions(_sheets(spark, d), keys, "text", "summary", 0)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line_no", "amount", F.col("value").cast("double").alias("value"), "type", "section", "context")


SUMMARY_SQL = f"""
WITH {PRICED}, k AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 'budget decrease' WHEN 'N' THEN 'grant revenue' ELSE 'contract payment' END AS words,
  CASE l_returnflag WHEN 'A' THEN 'expenditure_decrease' WHEN 'N' THEN 'revenue' ELSE 'expenditure' END AS t1,
  CASE l_linestatus WHEN 'O' THEN 'projected_costs' ELSE 'fiscal_impact' END AS section FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 4 AS line_no, shown AS amount, CAST(price AS DOUBLE) AS value, t1 AS type, section, 'Total ' || shown || ' for year ' || words AS context FROM k
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 5, shown, CAST(price AS DOUBLE), CASE section WHEN 'projected_costs' THEN 'expenditure' ELSE 'unspecified' END, section, 'next ' || shown FROM k
"""


def _mentions(spark, d):
    """Every line as a mention of an amount in its order; the part's last digit is the amount."""
    li = table(spark, d, "lineitem")
    amount = F.col("l_partkey") % 5
    context = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "expenditure decrease")
        .when(F.col("l_returnflag") == "A", F.when(F.col("l_quantity") > 25, "budget decrease").otherwise("credit (expenditure)"))
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "grant revenue")
        .when(F.col("l_returnflag") == "N", "revenue (expenditure)")
        .when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 40), "payment").otherwise("plain")
    )
    return li.select(
        "l_orderkey", F.lit(0).alias("source_rank"), F.concat(F.lit("src"), F.col("l_suppkey") % 3).alias("source"),
        F.col("l_linenumber").alias("line_no"), (F.col("l_partkey") * (1 << 24) + F.col("l_suppkey")).alias("amount_no"),
        F.concat(F.lit("$"), amount.cast("string")).alias("amount"), amount.cast(money.MONEY).alias("value"),
        money.entry_type(context).alias("type"),
        F.when(F.col("l_linestatus") == "O", "projected_costs").alias("section"), context.alias("context"),
    )


def consolidated_amounts(spark, d):
    """One entry per order and amount with the settled type."""
    out = finance.consolidate(_mentions(spark, d), ["l_orderkey"], contexts=False)
    return out.select(
        "l_orderkey", "amount", F.col("value").cast("double").alias("value"), "type", "section",
        "mentions", F.array_join("sources", ",").alias("sources"),
        F.col("signed_value").cast("double").alias("signed_value"),
    )


CONSOLIDATED_SQL = """
WITH RECURSIVE e AS MATERIALIZED (
  SELECT l_orderkey, '$' || (l_partkey % 5) AS amount, l_partkey % 5 AS val, 'src' || (l_suppkey % 3) AS src,
    CASE WHEN l_linestatus = 'O' THEN 'projected_costs' END AS section,
    CASE WHEN l_returnflag = 'A' THEN 'expenditure_decrease' WHEN l_returnflag = 'N' THEN 'revenue' WHEN l_linestatus = 'O' AND l_quantity > 40 THEN 'expenditure' ELSE 'unspecified' END AS t,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'D' WHEN l_returnflag = 'A' AND l_quantity > 25 THEN '' WHEN l_returnflag = 'A' THEN 'E'
         WHEN l_returnflag = 'N' AND l_linestatus <> 'O' THEN 'E' WHEN l_returnflag NOT IN ('A', 'N') AND l_linestatus = 'O' AND l_quantity > 40 THEN 'E' ELSE '' END AS force,
    row_number() OVER (PARTITION BY l_orderkey, l_partkey % 5 ORDER BY l_linenumber, l_partkey * 16777216 + l_suppkey) AS n
  FROM lineitem),
f AS (
  SELECT l_orderkey, amount, n, t AS state FROM e WHERE n = 1
  UNION ALL
  SELECT e.l_orderkey, e.amount, e.n, CASE WHEN f.state = 'unspecified' THEN e.t WHEN f.state = e.t THEN f.state
     WHEN e.force = 'D' THEN 'expenditure_decrease' WHEN e.force = 'E' THEN 'expenditure' ELSE f.state END
  FROM f JOIN e ON e.l_orderkey = f.l_orderkey AND e.amount = f.amount AND e.n = f.n + 1),
last AS (SELECT l_orderkey, amount, arg_max(state, n) AS type FROM f GROUP BY 1, 2),
agg AS (SELECT l_orderkey, amount, max(val) AS val, count(*) AS mentions, min(section) AS section, string_agg(DISTINCT src, ',' ORDER BY src) AS sources FROM e GROUP BY 1, 2)
SELECT l_orderkey, amount, CAST(val AS DOUBLE) AS value, type, section, mentions, sources,
  CAST(CASE type WHEN 'expenditure' THEN val WHEN 'unspecified' THEN 0 ELSE -val END AS DOUBLE) AS signed_value
FROM agg JOIN last USING (l_orderkey, amount)
"""


def _details(spark, d):
    """Lines as financial details: item = order, type and section from the flags."""
    li = table(spark, d, "lineitem")
    kind = F.when(F.col("l_returnflag") == "A", "expenditure").when(F.col("l_returnflag") == "N", "revenue").when(F.col("l_linenumber") % 2 == 0, "expenditure_decrease").otherwise("unspecified")
    section = F.when(F.col("l_linestatus") == "O", "fiscal_impact").when(F.col("l_linenumber") > 3, "projected_costs")
    out = li.select("l_orderkey", _cents("l_extendedprice").alias("value"), kind.alias("type"), section.alias("section"))
    return out.withColumn("signed_value", money.signed_value("type", "value"))


DETAILS = """
dt AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS value,
  CASE WHEN l_returnflag = 'A' THEN 'expenditure' WHEN l_returnflag = 'N' THEN 'revenue' WHEN l_linenumber % 2 = 0 THEN 'expenditure_decrease' ELSE 'unspecified' END AS type,
  CASE WHEN l_linestatus = 'O' THEN 'fiscal_impact' WHEN l_linenumber > 3 THEN 'projected_costs' END AS section FROM lineitem)
"""


def item_totals(spark, d):
    out = finance.item_totals(_details(spark, d), ["l_orderkey"])
    return out.select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in ("expenditures", "decreases", "revenues", "other", "net")])


TOTALS_SQL = f"""
WITH {DETAILS} SELECT l_orderkey,
  CAST(coalesce(sum(value) FILTER (type = 'expenditure'), 0) AS DOUBLE) AS expenditures,
  CAST(coalesce(sum(value) FILTER (type = 'expenditure_decrease'), 0) AS DOUBLE) AS decreases,
  CAST(coalesce(sum(value) FILTER (type = 'revenue'), 0) AS DOUBLE) AS revenues,
  CAST(coalesce(sum(value) FILTER (type = 'unspecified'), 0) AS DOUBLE) AS other,
  CAST(coalesce(sum(CASE type WHEN 'expenditure' THEN value WHEN 'unspecified' THEN 0 ELSE -value END), 0) AS DOUBLE) AS net
FROM dt GROUP BY 1
"""

FIGURES = DETAILS + """,
fg AS (SELECT l_orderkey, max(value) AS amount,
  coalesce(max(value) FILTER (type = 'expenditure' AND section = 'fiscal_impact'), sum(value) FILTER (type = 'expenditure' AND section = 'projected_costs'),
           max(value) FILTER (type = 'expenditure')) AS expenditure FROM dt GROUP BY 1)
"""


def item_figures(spark, d):
    out = finance.item_figures(_details(spark, d), ["l_orderkey"])
    return out.select("l_orderkey", F.col("amount").cast("double").alias("amount"), F.col("expenditure").cast("double").alias("expenditure"))


def meeting_finance(spark, d):
    """Summary per customer; urgent orders stand for second parts and are left out."""
    fig = finance.item_figures(_details(spark, d), ["l_orderkey"])
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "Contract (Part 2) See Item 7").otherwise("Contract Part 1").alias("title"),
    )
    out = finance.meeting_summary(fig.join(o, "l_orderkey"), "o_custkey", "l_orderkey", "title")
    dbl = ["total_discussed", "smallest_amount", "largest_amount", "total_expenditures", "smallest_expenditure", "largest_expenditure"]
    return out.select("o_custkey", "item_count", "smallest_item", "largest_item", "expenditure_items", *[F.col(c).cast("double").alias(c) for c in dbl])


MEETING_SQL = f"""
WITH {FIGURES} SELECT o_custkey, count(amount) FILTER (amount > 0) AS item_count,
  arg_min(l_orderkey, (amount, l_orderkey)) AS smallest_item, arg_max(l_orderkey, (amount, l_orderkey)) AS largest_item,
  count(expenditure) AS expenditure_items, CAST(sum(amount) AS DOUBLE) AS total_discussed, CAST(min(amount) AS DOUBLE) AS smallest_amount,
  CAST(max(amount) AS DOUBLE) AS largest_amount, CAST(coalesce(sum(expenditure), 0) AS DOUBLE) AS total_expenditures,
  CAST(min(expenditure) AS DOUBLE) AS smallest_expenditure, CAST(max(expenditure) AS DOUBLE) AS largest_expenditure
FROM fg JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority <> '1-URGENT' GROUP BY 1
"""

QUERIES = {
    "amounts_found": (amounts_found, AMOUNTS_SQL),
    "amount_values": (amount_values, AMOUNT_VALUES_SQL),
    "entry_types": (entry_types, TYPES_SQL),
    "summary_entries": (summary_entries, SUMMARY_SQL),
    "consolidated_amounts": (consolidated_amounts, CONSOLIDATED_SQL),
    "item_totals": (item_totals, TOTALS_SQL),
    "item_figures": (item_figures, f"WITH {FIGURES} SELECT l_orderkey, CAST(amount AS DOUBLE) AS amount, CAST(expenditure AS DOUBLE) AS expenditure FROM fg"),
    "meeting_finance": (meeting_finance, MEETING_SQL),
}
