"""Streams with keyed state: rows out of order, late rows, restarts, and forgotten keys."""

from __future__ import annotations

import datetime

import pytest

from gavel.streaming import incremental, stateful

SCHEMA = "m long, id long, ts timestamp, who string"
START = datetime.datetime(2024, 1, 1)


def _row(m, i, minute, who="A"):
    return (m, i, START + datetime.timedelta(minutes=minute), who)


def _us(minute):
    return int((START - datetime.datetime(1970, 1, 1)).total_seconds() * 1_000_000) + minute * 60_000_000


def _run(spark, tmp_path, batches, shape):
    """Each batch is one file and one run from the same checkpoint."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for rows in batches:
        rows = [(m, i, ts.replace(tzinfo=datetime.timezone.utc), who) for m, i, ts, who in rows]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.new_files(spark, f"{tmp_path}/in", SCHEMA)
        with stateful.keyed_state(spark):
            query = (
                shape(stream).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                .option("checkpointLocation", f"{tmp_path}/state").option("path", f"{tmp_path}/table").start()
            )
            query.awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/table").where("m >= 0").collect())


END = [_row(-1, -1, 100_000)]


def test_gaps_over_files_out_of_order(spark, tmp_path):
    batches = [[_row(1, 1, 0), _row(1, 3, 200, "C"), _row(2, 9, 5)], [_row(1, 2, 30, "B"), _row(1, 4, 261, "D"), _row(2, 8, 65)], END]
    found = _run(spark, tmp_path, batches, lambda s: stateful.streamed_gaps(s, "m", "ts", "id", "who", 60, "300 minutes"))
    assert found == [(1, 1, _us(30), _us(200), "C"), (1, 2, _us(200), _us(261), "D")]  # exactly sixty minutes is no gap


def test_late_rows_are_dropped(spark, tmp_path):
    batches = [[_row(1, 1, 0), _row(1, 2, 500)], [_row(1, 3, 400)], END]
    found = _run(spark, tmp_path, batches, lambda s: stateful.streamed_gaps(s, "m", "ts", "id", "who", 60, "10 minutes"))
    assert found == [(1, 1, _us(0), _us(500), "A")]


@pytest.mark.parametrize("forget", [None, 24 * 3_600_000])
def test_turns_ties_nulls_and_forgotten_meetings(spark, tmp_path, forget):
    first = [_row(1, 2, 0, "A"), _row(1, 1, 0, "B"), _row(1, 3, 10, "A"), _row(1, 4, 20, None), _row(1, 5, 21, None), _row(1, 6, 90, None)]
    later = [_row(1, 7, 50_000, "A")]
    found = _run(spark, tmp_path, [first, later, END], lambda s: stateful.streamed_turns(s, "m", "ts", "id", "who", 60, "30 minutes", forget))
    want = [(1, 1, "B", _us(0), _us(0), 1), (1, 2, "A", _us(0), _us(10), 2), (1, 3, None, _us(20), _us(21), 2), (1, 4, None, _us(90), _us(90), 1)]
    want.append((1, 5 if forget is None else 1, "A", _us(50_000), _us(50_000), 1))
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_meetings_of_a_bucket_share_a_state(spark, tmp_path):
    batches = [[_row(m, 10 * m + k, 7 * m + 45 * k * (1 + m % 2), "AB"[k % 2]) for m in range(40) for k in ks] for ks in ((0, 2, 3), (1, 4))]
    shape = lambda buckets: lambda s: stateful.streamed_gaps(s, "m", "ts", "id", "who", 60, "1000 minutes", buckets=buckets)
    found = _run(spark, tmp_path / "shared", [*batches, END], shape(3))
    assert found == [(m, k, _us(7 * m + 90 * (k - 1)), _us(7 * m + 90 * k), "AB"[k % 2]) for m in range(1, 40, 2) for k in range(1, 5)]
    keys = spark.read.format("state-metadata").load(f"{tmp_path}/shared/state")
    assert keys.select("operatorName").distinct().first()[0] != "transformWithStateInPandasExec"  # one exchange per state, not per call
    assert spark.read.format("statestore").load(f"{tmp_path}/shared/state").count() == 3
