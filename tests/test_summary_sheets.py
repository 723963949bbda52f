"""Summary sheets: tasks follow the rows, and white space is that of single lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.plans import finance
from gavel.queries import finance as queries


def test_tasks_do_not_grow_with_the_input(spark, tmp_path):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    li = spark.range(0, 20 * queries.PRICED_ROWS, 1, 1).select(*[F.lit(1).cast("long").alias(c) for c in columns], F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"))
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert queries._priced(spark, str(tmp_path)).rdd.getNumPartitions() >= 20


def test_white_space_of_lines(spark):
    sheet = "FISCAL  IMPACT:\r\n   grant \t revenue\x0b\n \n Total  $5   a\r\n\n"
    found = spark.createDataFrame([(sheet,)], "t string").select(F.explode(finance.summary_lines("t")).alias("e")).select("e.*").collect()
    assert [(r["line_no"], r["section"], r["context"], r["amounts"]) for r in found] == [(2, "fiscal_impact", "Total $5   a grant revenue", ["$5"])]
