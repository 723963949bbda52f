"""Folio numbers come in the order of their values, however many digits they have."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.functions.text import folio_numbers


def test_order_of_values(spark):
    text = "1050000, 950000.0000 and 12345678, 99999; 950000, 1234, 950000.0000"
    row = spark.range(1).select(folio_numbers(F.lit(text)).alias("f")).first()
    assert row["f"] == ["99999", "950000", "950000.0000", "1050000", "12345678"]
