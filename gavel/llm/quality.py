"""Quality rules with host verdicts.

Every document gets counts over its whole text and a base verdict.  Failures are then summed
by host, each host's failure rate is shrunk towards the mean of all hosts with a beta prior
whose two parameters are estimated from the hosts themselves (method of moments), and a host
whose shrunk rate reaches the limit takes its documents with it.

Scale: one pass of Arrow batches computes slim counts; host sums combine before the shuffle;
the prior is one row.  Only rejected hosts are joined back: broadcast when their counted number
is small, else joined with salted keys, so that a host with a third of all rows is spread.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import BLANKS, small_batches
from gavel.session import stored

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PER_CENT = 50

#: Hosts at or above this shrunk failure rate are rejected.
HOST_LIMIT = 0.8
BROADCAST_HOSTS = 100_000
SALTS = 32

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
NAMES = [c.split()[0] for c in COUNTS.split(", ")]


def _repeated(words: list[bytes], n: int = 3) -> int:
    """Words that lie in a window of n words found twice or more."""
    windows = list(zip(*(words[k:] for k in range(n)), strict=False))
    if len(windows) == len(set(windows)):
        return 0
    first: dict[tuple, int] = {}
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            hit[j : j + n] = hit[i : i + n] = b"\x01" * n
    return sum(hit)


def measure(text: str | None) -> tuple:
    """The counts of one text; a null text has no words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at the six ASCII blanks, and only there
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in data.split(b"\n"):
        if line.strip(BLANKS):
            repeated_lines += line in seen
            seen.add(line)
    joined = b"".join(words)
    chars = len(joined) - sum(joined.count(bytes([b])) for b in range(0x80, 0xC0)) if not joined.isascii() else len(joined)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeated = _repeated(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PER_CENT * len(words)
    return len(words), chars, symbols, repeated_lines, repeated, failed


def _measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=NAMES)


def counts(text: Column) -> Column:
    """The counts of a text column as one struct."""
    return F.pandas_udf(_measured, COUNTS)(text)


def host_rates(documents: DataFrame, host: str, failed: str) -> DataFrame:
    """host, n, bad and the failure rate shrunk with the empirical beta prior of all hosts.

    Mean m and variance v of the hosts' raw rates give the prior's weight k = m(1-m)/v - 1; without spread
    (one host, or equal rates) the weight is unbounded and every host gets the mean.  Null hosts are no host."""
    hosts = (
        documents.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("bad"))
    )
    m, v = hosts.select(F.avg(F.col("bad") / F.col("n")), F.var_pop(F.col("bad") / F.col("n"))).first()
    if m is None:
        return hosts.withColumn("rate", F.lit(None).cast("double"))
    weight = max(m * (1 - m) / v - 1, 0.0) if v > 1e-12 else None
    rate = (F.col("bad") + F.lit(m * weight)) / (F.col("n") + F.lit(weight)) if weight is not None else F.lit(m)
    return hosts.withColumn("rate", rate.cast("double"))


def apply_hosts(documents: DataFrame, hosts: DataFrame, host: str, out: str, limit: float = HOST_LIMIT) -> DataFrame:
    """`documents` with a boolean `out`: its host is rejected.  Null hosts are not."""
    rejected = hosts.where(F.col("rate") >= limit).select("host")
    number = rejected.limit(BROADCAST_HOSTS + 1).count()
    if number == 0:
        return documents.withColumn(out, F.lit(False))
    if number <= BROADCAST_HOSTS:
        verdicts = F.broadcast(rejected.select(F.col("host").alias("_host"), F.lit(True).alias("_rejected")))
        joined = documents.join(verdicts, F.col(host) == F.col("_host"), "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
        verdicts = rejected.select(F.col("host").alias("_host"), F.lit(True).alias("_rejected"), salts)
        salted = documents.withColumn("_pick", F.floor(F.rand(7) * SALTS).cast("int"))
        joined = salted.join(verdicts, (F.col(host) == F.col("_host")) & (F.col("_pick") == F.col("_salt")), "left")
        joined = joined.drop("_pick", "_salt")
    return joined.withColumn(out, F.coalesce("_rejected", F.lit(False))).drop("_host", "_rejected")


def scored(documents: DataFrame, text: str, host: str, keep: tuple[str, ...]) -> DataFrame:
    """Slim rows: the columns in `keep`, the counts, `base_failed` and `kept`.

    Repeated rows each get their own row; empty and null texts have no words and fail; extra columns of the
    input, whatever their names, are left out.  An empty table gives an empty table."""
    small_batches(documents.sparkSession)
    slim = documents.select(
        F.struct(*[F.col(c) for c in keep]).alias("keep"), F.col(host).alias("host_key"), counts(F.col(text)).alias("q")
    )
    slim = stored(slim.select("keep", "host_key", "q.*"), "quality")
    hosts = host_rates(slim, "host_key", "base_failed")
    judged = apply_hosts(slim, hosts, "host_key", "host_failed")
    return judged.select(
        "keep.*",
        *NAMES,
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )


def filtered(documents: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that the rules keep, all columns as they were.

    Counts are taken twice, for the hosts and for the rows, so that texts are neither shuffled nor stored."""
    small_batches(documents.sparkSession)
    failed = counts(F.col(text))["base_failed"]
    slim = stored(documents.select(F.col(host).alias("host_key"), failed.alias("base_failed")), "quality")
    hosts = host_rates(slim, "host_key", "base_failed")
    good = documents.where(~failed).select(F.struct(*_all(documents)).alias("doc"), F.col(host).alias("host_key"))
    judged = apply_hosts(good, hosts, "host_key", "host_failed")
    return judged.where(~F.col("host_failed")).select("doc.*")


def _all(documents: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in documents.columns]
