"""Helpers that several operators of this package share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Byte tables: true where a UTF-8 byte belongs to a word.  The first class is everything but the six ASCII
#: blanks; the second is ASCII digits and letters and every byte of a character beyond ASCII.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NOT_BLANK = np.array([b not in BLANKS for b in range(256)])
ALNUM = np.array([b >= 0x80 or chr(b).isascii() and chr(b).isalnum() for b in range(256)])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Arrow batches of bounded rows and bytes: a Python worker never holds more than one batch of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def as_bytes(column: Column | str) -> Column:
    """UTF-8 bytes of a text; null stays null."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


#: Places of marks: 4 MB of bits at most, whatever the input.
PLACES = 1 << 25


def marks(rows: DataFrame, hashed: str) -> DataFrame:
    """bucket, bits: one bit at the place of every hash; small enough to be broadcast at any size of the input."""
    places = rows.select(F.pmod(hashed, F.lit(PLACES)).alias("place"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    return places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(bits)


def marked(rows: DataFrame, hashed: str, bits: DataFrame) -> DataFrame:
    """`rows` with `marked`: false only where the hash is none of those in `marks`.  Nothing is moved but the marks."""
    place = F.pmod(hashed, F.lit(PLACES))
    at = F.bitmap_bit_position(place)
    held = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("bucket"), "left")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return held.withColumn("marked", flag).drop("bucket", "bits")


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def byte_values(column: pa.Array) -> Iterator[bytes]:
    """The values of a binary column, null as empty."""
    for value in column:
        yield value.as_py() or b""


def word_hashes(data: bytes, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash, start, end) of every word of `data`; `word` says which bytes belong to words."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = word[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    letters = raw[inside[1:-1] == 1].astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
        hashes = np.add.reduceat(letters * power[place], first)
    return mixed(hashes), starts, ends


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Order-aware 64-bit hashes of all runs of n words."""
    out = words[: len(words) - n + 1].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k])
    return out
