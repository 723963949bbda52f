"""The chunked road of every sequence operator against plain windows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gavel.operators.clusters import anchored_clusters
from gavel.operators.ranges import asof_backward
from gavel.operators.sequence import Carry, First, Lowest, Next, Position, Prev, Running, RunningMax, Sequence, Total, chunked


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; a burst shares one time; some values are null."""
    rows = spark.range(0, 4000).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 9).alias("k"),
        F.when(F.col("id").between(1000, 1800), 500).otherwise(F.col("id") * 7 % 3001).alias("t"),
        "id",
        F.when(F.col("id") % 5 == 0, F.col("id") * 2).alias("v"),
    )
    return rows.cache()


def expected(df):
    w = Window.partitionBy("k").orderBy("t", "id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        F.lag("v").over(w).alias("prev"),
        F.lead("v").over(w).alias("next"),
        F.last("v", True).over(w).alias("carry"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        F.max("v").over(w).alias("top"),
        F.row_number().over(w).cast("bigint").alias("pos"),
        F.first("v").over(whole).alias("first"),
        F.sum("id").over(whole).alias("total"),
        F.min("v").over(whole).alias("low"),
    )


def every_op():
    return dict(
        prev=Prev("v"), next=Next("v"), carry=Carry("v"), before=Carry("v", before=True), running=Running("id"),
        top=RunningMax("v"), pos=Position(), first=First("v"), total=Total("id"), low=Lowest("v"),
    )


@pytest.mark.parametrize("target", [50, 700, 1_000_000])
def test_same_as_windows(skewed, target):
    seq = Sequence(["k"], ["t", "id"], ["t", "id"], target_rows=target)
    got = seq.apply(skewed, **every_op())
    want = expected(skewed)
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_global_sequence(skewed):
    got = Sequence([], ["t", "id"], ["t", "id"], target_rows=100).apply(skewed, pos=Position())
    want = skewed.withColumn("pos", F.row_number().over(Window.orderBy("t", "id")).cast("bigint"))
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_chunks_are_bounded(skewed):
    cut = chunked(skewed, ["k"], ["t", "id"], target_rows=200)
    largest = cut.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 200  # the hot key has 2800 rows, 801 of them at one time


@pytest.mark.parametrize("target", [60, 1_000_000])
def test_asof_matches_brute_force(spark, skewed, target):
    left = skewed.where("v is not null").select("k", "id", "t")
    right = skewed.where("v is null and id % 3 = 0").select("k", F.col("t").alias("start"), F.col("id").alias("part"))
    got = asof_backward(left, right, ["k"], "t", "start", "part", target_rows=target).select("k", "id", F.col("match.part").alias("part"))
    pairs = left.join(right, "k").where("start <= t")
    best = pairs.groupBy("k", "id").agg(F.max_by("part", F.struct("start", -F.col("part"))).alias("p"))
    first = right.groupBy("k").agg(F.min_by("part", F.struct("start", "part")).alias("f"))
    want = left.join(best, ["k", "id"], "left").join(first, "k", "left").select("k", "id", F.coalesce("p", "f").alias("part"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_asof_is_monotone(skewed):
    left = skewed.where("v is not null").select("k", "id", "t")
    right = skewed.where("v is null").select("k", F.col("t").alias("start"), F.col("id").alias("part"))
    out = asof_backward(left, right, ["k"], "t", "start", "part")
    w = Window.partitionBy("k").orderBy("t", "id")
    back = out.withColumn("s", F.col("match.start")).withColumn("p", F.lag("s").over(w)).where("s < p")
    assert back.count() == 0


@pytest.mark.parametrize("target", [40, 1_000_000])
def test_clusters_match_a_plain_loop(spark, skewed, target):
    got = anchored_clusters(skewed.select("k", "id", "t"), ["k"], "t", 30.0, target_rows=target)
    rows = got.select("k", "id", "t", "anchor").collect()
    want = {}
    for k in {r["k"] for r in rows}:
        start = None
        for t in sorted({r["t"] for r in rows if r["k"] == k}):
            if start is None or t - start > 30:
                start = t
            want[(k, t)] = start
    assert len(rows) == skewed.count()
    assert all(r["anchor"] == want[(r["k"], r["t"])] for r in rows)


def test_partition_invariance(spark, skewed):
    seq = Sequence(["k"], ["t", "id"], ["t", "id"], target_rows=100)
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, seq.apply(skewed.repartition(int(n)), pos=Position(), before=Carry("v", before=True)).select("k", "id", "pos", "before").collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_leading_nulls_and_ties_in_chunks(spark):
    """Sums stay null until the first value, and rows that tie on every number are cut by their text."""
    rows = [(1, 0, f"t{i:05d}", None if i < 300 else i) for i in range(1200)]
    df = spark.createDataFrame(rows, "k int, t int, name string, v long")
    ops = {"total": Running("v"), "pos": Position()}
    cut = Sequence(["k"], ["t", "name"], ["t"], target_rows=100).apply(df, **ops)
    plain = Sequence(["k"], ["t", "name"], ["t"]).apply(df, **ops)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    assert cut.where("total is null").count() == 300
    assert chunked(df, ["k"], ["t", "name"], 100).groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 200
