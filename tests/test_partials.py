"""Merged partial aggregates against the whole recomputation."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from gavel.plans.partials import Partials


def test_merged_batches_equal_the_whole(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(50)]), rng.randint(0, 4000), rng.randrange(4)) for _ in range(20_000)]
    table = spark.createDataFrame(rows, "k string, v int, who int, b int")
    totals = Partials(spark, str(tmp_path / "t"), ["k"], {"total": "v", "big": F.when(F.col("v") > 40, 1).otherwise(0)}, {"people": "who"})
    totals.add(table.where("b = 0").limit(7), "0")  # delivered again below
    for b in range(4):
        totals.add(table.where(F.col("b") == b), str(b))
    totals.add(table.where("b = 3"), "3")
    found = {r["k"]: r for r in totals.read().collect()}
    whole = table.groupBy("k").agg(F.count("*").alias("rows"), F.sum("v").alias("total"), F.count(F.when(F.col("v") > 40, 1)).alias("big"), F.count_distinct("who").alias("people"))
    for w in whole.collect():
        got = found.pop(w["k"])
        assert (got["rows"], got["total"], got["big"]) == (w["rows"], w["total"], w["big"])
        assert abs(got["people"] - w["people"]) <= 0.05 * w["people"]
    assert not found and totals.stored().count() == 12  # one row per key and batch
