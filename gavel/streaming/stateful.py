"""Pauses and turns of a running stream of segments, with state per meeting.

Rows may come out of order within the watermark's delay.  A meeting's rows wait in its state until the watermark has
passed them, and are then taken in the order of (time, tie), so results do not depend on how rows fell into
micro-batches.  Rows at or before the watermark of an earlier batch are late and are dropped by Spark.  One event-time timeout
per state wakes it for its next waiting row or for the end of its silence.

State is what the next row needs: the last time, the number of the last pause or turn, and the open turn.  Waiting rows are
bounded by what a meeting says within the delay.  `forget` drops a meeting's state after so long a silence; a
meeting that speaks again after that is numbered anew.

Rows whose time is null never pass a watermark: they are filtered out before the state.  A null label is a label of its own.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

GAPS = "gap_no long, end_us long, resume_us long, label string"
TURNS = "turn_no long, label string, first_us long, last_us long, segments long"


@contextmanager
def keyed_state(spark: SparkSession):
    """Start queries with keyed state inside; the session's own state store is set back afterwards."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class _InOrder:
    """Gives the rows of a meeting to `step` in order of time, once the watermark has passed them.

    A state holds one meeting or the meetings of a bucket.  It comes with its rows and goes back with its results, so it
    costs no calls of its own to the state store; a bucket shares what Python spends on every state of a batch."""

    state_schema: str
    columns: list[str]

    def __init__(self, key: T.StructField, silence_ms: int, forget_ms: int | None) -> None:
        self.key_name, self.silence_ms, self.forget_ms = key.name, silence_ms, forget_ms
        kind = key.dataType.simpleString()
        fields = [f.split() for f in self.state_schema.split(", ")]
        self.kept_schema = f"w_key array<{kind}>, us array<long>, tie array<long>, said array<string>, s_key array<{kind}>, "
        self.kept_schema += ", ".join(f"s_{name} array<{of}>" for name, of in fields)
        self.width = len(fields)

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        waiting: dict[object, list[tuple]] = {}
        states: dict[object, tuple] = {}
        if kept.exists:
            w_key, us, tie, said, s_key, *fields = kept.get
            for k, *row in zip(w_key, us, tie, said, strict=True):
                waiting.setdefault(k, []).append(tuple(row))
            states = dict(zip(s_key, zip(*fields, strict=True), strict=True))
        if not kept.hasTimedOut:
            for frame in frames:
                label = [None if x is None or x != x else x for x in frame["label"].tolist()]
                for k, *row in zip(frame[self.key_name].tolist(), frame["us"].tolist(), frame["tie"].tolist(), label, strict=True):
                    waiting.setdefault(k, []).append(tuple(row))
        passed = kept.getCurrentWatermarkMs() * 1000
        out: list[tuple] = []
        rest: list[tuple] = []
        wakes: list[int] = []
        for k in list(dict.fromkeys([*waiting, *states])):
            found: list[tuple] = []
            state, left = self._taken(states.pop(k, None), sorted(waiting.get(k, ()), key=lambda r: r[:2]), passed, found)
            out += [(k, *r) for r in found]
            rest += [(k, *r) for r in left]
            if state is not None:
                states[k] = state
            wakes += [t for t in (left[0][0] if left else None, self.sleeps_until(state)) if t is not None]
        if not rest and not states:
            kept.remove()
        else:
            held = list(map(list, zip(*rest, strict=True))) or [[]] * 4
            fields = list(map(list, zip(*states.values(), strict=True))) or [[]] * self.width
            kept.update((*held, list(states), *fields))
            if wakes:
                # goes off when the watermark is later than this: from the millisecond on that holds the first of them
                kept.setTimeoutTimestamp(max(-(-min(wakes) // 1000) - 1, passed // 1000, 1))
        if out:
            yield pd.DataFrame(out, columns=[self.key_name, *self.columns])

    def _taken(self, state: tuple | None, rows: list[tuple], passed: int, out: list[tuple]) -> tuple[tuple | None, list[tuple]]:
        """The state after the rows that the watermark has passed, and the rows that wait on."""
        due = bisect_right(rows, passed, key=lambda r: r[0])
        for us, _, label in rows[:due]:
            state = self.step(state, us, label, out)
        return state if state is None else self.silent(state, passed, out), rows[due:]

    def step(self, state: tuple | None, us: int, label: str | None, out: list[tuple]) -> tuple:
        raise NotImplementedError

    def silent(self, state: tuple, passed: int, out: list[tuple]) -> tuple | None:
        raise NotImplementedError

    def sleeps_until(self, state: tuple | None) -> int | None:
        raise NotImplementedError


class _Gaps(_InOrder):
    state_schema = "last_us long, gaps long"
    columns = [c.split()[0] for c in GAPS.split(", ")]

    def step(self, state, us, label, out):
        last, gaps = state or (us, 0)
        if us - last > self.silence_ms * 1000:
            gaps += 1
            out.append((gaps, last, us, label))
        return us, gaps

    def silent(self, state, passed, out):
        until = self.sleeps_until(state)
        return None if until is not None and until <= passed else state

    def sleeps_until(self, state):
        return None if state is None or self.forget_ms is None else state[0] + self.forget_ms * 1000


class _Turns(_InOrder):
    state_schema = "turn_no long, open boolean, label string, first_us long, last_us long, segments long"
    columns = [c.split()[0] for c in TURNS.split(", ")]

    def step(self, state, us, label, out):
        if state is not None:
            number, opened, said, first, last, segments = state
            if opened and said == label and us - last <= self.silence_ms * 1000:
                return number, True, label, first, us, segments + 1
            if opened:
                out.append((number, said, first, last, segments))
        return (state[0] if state else 0) + 1, True, label, us, us, 1

    def silent(self, state, passed, out):
        number, opened, said, first, last, segments = state
        if opened and last + self.silence_ms * 1000 < passed:
            out.append((number, said, first, last, segments))
            opened = False
        if self.forget_ms is not None and last + self.forget_ms * 1000 <= passed:
            return None
        return number, opened, said, first, last, segments

    def sleeps_until(self, state):
        if state is None:
            return None
        if state[1]:
            return state[4] + self.silence_ms * 1000
        return None if self.forget_ms is None else state[4] + self.forget_ms * 1000


def _run(
    processor: type[_InOrder], schema: str, segments: DataFrame, key: str, time: str, tie: str, label: str, silence_ms: int, late: str, forget_ms: int | None,
    buckets: int | None,
) -> DataFrame:
    rows = segments.where(F.col(time).isNotNull() & F.col(key).isNotNull()).select(
        key, F.col(time).alias("at"), F.unix_micros(time).alias("us"), F.col(tie).cast("long").alias("tie"), F.col(label).cast("string").alias("label")
    )
    if buckets is not None:
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    whole = f"{key} {segments.schema[key].dataType.simpleString()}, {schema}"
    run = processor(segments.schema[key], silence_ms, forget_ms)
    return (
        rows.withWatermark("at", late)
        .groupBy(key if buckets is None else "_bucket")
        .applyInPandasWithState(run, whole, run.kept_schema, "append", GroupStateTimeout.EventTimeTimeout)
    )


def streamed_gaps(
    segments: DataFrame, key: str, time: str, tie: str, label: str, min_gap_minutes: float = 60.0, late: str = "10 minutes", forget_ms: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Pauses strictly longer than the threshold, numbered per meeting: key, gap_no, end_us, resume_us and the label that resumes.

    `buckets` keeps meetings together in so many states; it should follow the number of meetings and cannot change
    while a checkpoint lives."""
    return _run(_Gaps, GAPS, segments, key, time, tie, label, int(min_gap_minutes * 60_000), late, forget_ms, buckets)


def streamed_turns(
    segments: DataFrame, key: str, time: str, tie: str, label: str, silence_minutes: float = 60.0, late: str = "10 minutes", forget_ms: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Runs of one label without a longer silence, given out when they are over: key, turn_no, label, first_us, last_us, segments.

    `buckets` as for `streamed_gaps`."""
    return _run(_Turns, TURNS, segments, key, time, tie, label, int(silence_minutes * 60_000), late, forget_ms, buckets)
