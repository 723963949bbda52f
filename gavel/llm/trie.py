"""The prefix trie of all conversations, by van Emde Boas recursion on depth.

A block of sequences that hang from one node is cut at half its depth.  Equal upper halves get one name, the least
conversation that has them, and stay as one sequence; what follows a cut hangs from the node so named.
All upper tries and lower forests of a level are cut again in the same jobs, until a sequence is one turn long:
what is then left is the trie, one row per node, keyed by (least conversation, depth).  Totals of whole
blocks are then grafted upward, level by level, and what lies below each cut is handed to the nodes above it.

Equal halves are found by digests of aligned blocks of turns, which are built in pairs from the turns up.  Every
sequence carries an end mark as its last turn, so a node whose conversations end there has a child for it.

Scale: a conversation is rows, never an array, so one of any length is spread over tasks.  The number of rounds is the
logarithm of the longest conversation.  A round moves only sequences that reach its cut, each once, as
ids and digests; texts are read once.  Groups combine before the shuffle; a prefix that a third of all
conversations share is joined in salted parts.  Ids that end at a node are hashed as a stream of sorted pieces.

Cases: null role or text is empty; null turns come first; rows of a conversation tied on the turn are ordered by the digest of
role and text, and all stay; rows without conv_id belong to no conversation; the block of a negative id is counted towards
zero; extra columns are not read; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.common import small_batches
from gavel.operators.sequence import Position, Sequence
from gavel.session import stored

#: How conversations are rebuilt: turns shared with the first of each hundred, by a checksum.
BLOCK = 100
SHARED = 6
SALTS = 32


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns(conversations: DataFrame) -> DataFrame:
    """conv, at (from 0), digest, chars: one row per turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string").cast("binary")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").isNotNull().alias("told"),
        F.coalesce(F.col("turn"), F.lit(0)).alias("turn"),
        _sha(size, F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    placed = Sequence(keys=["conv"], order=["told", "turn", "digest"]).apply(rows, at=Position())
    return placed.select("conv", (F.col("at") - 1).alias("at"), "digest", "chars")


def rebuilt(rows: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """Every conversation with its first h turns taken from the first of its block of ids."""
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"))
    conv, own = F.col("conv"), F.col("n")
    h = F.crc32(conv.cast("string").cast("binary")) % shared
    first = sizes.select(F.col("conv").alias("first"), F.col("n").alias("n_first"))
    info = sizes.select("conv", h.alias("h"), (conv - conv % block).alias("first"), own).join(first, "first", "left")
    taken = F.least("h", F.coalesce("n_first", F.lit(0)))
    info = info.select("conv", "h", "first", taken.alias("taken"), (taken + F.greatest(own - F.col("h"), F.lit(0))).alias("size"))
    info = stored(info, "conversations")

    heads = rows.where((conv % block == 0) & (F.col("at") < shared)).withColumnRenamed("conv", "first")
    lent = info.join(heads, "first").where(F.col("at") < F.col("h")).select("conv", "at", "digest", "chars")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    gaps = info.where("taken < h").select("conv", (F.col("h") - F.col("taken")).alias("gap"), salts)
    kept = rows.where(F.col("at") >= h).withColumn("salt", (F.col("at") % SALTS).cast("int")).join(gaps, ["conv", "salt"], "left")
    kept = kept.select("conv", (F.col("at") - F.coalesce("gap", F.lit(0))).alias("at"), "digest", "chars")
    ends = info.select("conv", F.col("size").alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return lent.unionByName(kept).unionByName(ends)


def _blocks(symbols: DataFrame, levels: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Digests of all aligned blocks of 1, 2, 4 ... turns, and at each level the conversations that are one block."""
    end = F.col("digest").isNull()
    now = symbols.select("conv", F.col("at").alias("base"), F.coalesce("digest", F.lit(b"")).alias("digest"), end.alias("last"), F.lit(1).cast("long").alias("len"))
    blocks, whole = [now], []
    for k in range(levels):
        done = (F.col("base") == 0) & F.col("last")
        whole.append(blocks[-1].where(done))
        upper = F.col("base") % (2 << k) == 0
        pair = blocks[-1].where(~done).groupBy("conv", (F.col("base") - F.col("base") % (2 << k)).alias("base"))
        both = pair.agg(
            F.max(F.when(upper, F.col("digest"))).alias("a"),
            F.max(F.when(~upper, F.col("digest"))).alias("b"),
            F.max("last").alias("last"),
            F.sum("len").alias("len"),
        )
        digest = _sha(F.col("a"), F.coalesce("b", F.lit(b"")))
        blocks.append(stored(both.select("conv", "base", digest.alias("digest"), "last", "len"), "blocks"))
    whole.append(blocks[-1].where((F.col("base") == 0) & F.col("last")))
    return blocks, whole


def _level(size: Column) -> Column:
    """The round that cuts a sequence first: bits of its length."""
    return F.length(F.bin(size)).alias("level")


def _cut(active: DataFrame, halves: DataFrame, half: int) -> tuple[DataFrame, DataFrame]:
    """One round: (uppers, lowers) of all blocks of 2 * half turns.

    uppers  root, base, item (the name), n: distinct upper halves
    lowers  root (a name), base, item, n, len, from_base: what follows them"""
    left = halves.select(F.col("conv").alias("item"), "base", F.col("digest").alias("left"))
    rows = stored(
        active.join(left, ["item", "base"]).withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)).cast("int")), "cut"
    )
    parts = rows.groupBy("root", "base", "left", "salt").agg(F.min("item").alias("least"), F.sum("n").alias("n"))
    equal = Window.partitionBy("root", "base", "left")  # at most SALTS rows
    named = parts.select("*", F.min("least").over(equal).alias("name"), F.sum("n").over(equal).alias("all"))
    named = stored(named, "named")
    uppers = named.where("least = name").select("root", "base", F.col("name").alias("item"), F.col("all").alias("n"))
    keys = named.select("root", "base", "left", "salt", "name")
    below = rows.where(F.col("len") > half).join(keys, ["root", "base", "left", "salt"])
    lowers = below.select(
        F.col("name").alias("root"),
        (F.col("base") + half).alias("base"),
        "item",
        "n",
        (F.col("len") - half).alias("len"),
        F.col("base").alias("from_base"),
    )
    return uppers, stored(lowers, "lowers")


VALUES = ("leaves", "saved")


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).alias(name)


def _block_totals(uppers: list[DataFrame], nodes: DataFrame) -> list[DataFrame]:
    """Totals of all nodes of a block, by (root, base), for blocks of 1, 2, 4 ... turns."""
    sums = [F.sum(v).alias(v) for v in VALUES]
    totals = [stored(nodes.groupBy("root", "base").agg(*sums), "totals")]
    for k, up in enumerate(uppers):
        half = 1 << k
        below = totals[-1].withColumnRenamed("root", "item").withColumn("base", F.col("base") - half)
        grafts = up.join(below, ["item", "base"]).select("root", "base", *VALUES)
        same = totals[-1].where(F.col("base") % (2 * half) == 0)
        totals.append(stored(same.unionByName(grafts).groupBy("root", "base").agg(*sums), "totals"))
    return totals


def _below(uppers: list[DataFrame], lowers: list[DataFrame], totals: list[DataFrame]) -> DataFrame:
    """item, base, leaves, saved: the totals of everything strictly below each node."""
    sums = [F.sum(v).alias(v) for v in VALUES]
    beyond = None  # what lies beyond each sequence that fills its block
    for k in reversed(range(len(uppers))):
        half = 1 << k
        grafts = totals[k].select(F.col("root").alias("item"), (F.col("base") - half).alias("base"), *VALUES)
        passed = None
        if beyond is not None:
            full = lowers[k].where(F.col("len") == half).select("root", "base", "item", "from_base")
            carried = beyond.withColumnRenamed("base", "from_base")
            passed = stored(full.join(carried, ["item", "from_base"]), "passed")
            more = passed.select(F.col("root").alias("item"), F.col("from_base").alias("base"), *VALUES)
            grafts = grafts.unionByName(more)
        mine = uppers[k].select("item", "base").join(grafts, ["item", "base"]).groupBy("item", "base").agg(*sums)
        if passed is not None:
            mine = mine.unionByName(passed.select("item", "base", *VALUES))
        beyond = stored(mine, "beyond")
    return beyond


ENDS = "item long, ends_sha256 string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv) to comma-joined pieces, one for each run of a digest in a batch."""
    for batch in batches:
        runs: list[tuple[bytes, list[int]]] = []
        for digest, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not runs or runs[-1][0] != digest:
                runs.append((digest, []))
            runs[-1][1].append(conv)
        columns = [[d for d, _ in runs], [c[0] for _, c in runs], [",".join(map(str, c)) for _, c in runs]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            names=["digest", "first", "text"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one hash per digest; only the state of one hash is held."""
    now, least, state = None, None, None
    for batch in batches:
        done: list[tuple[int, str]] = []
        for digest, first, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if digest != now:
                if state:
                    done.append((least, state.hexdigest()))
                now, least, state = digest, first, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield _ended(done)
    if state:
        yield _ended([(least, state.hexdigest())])


def _ended(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["item", "ends_sha256"]
    )


def _ends(whole: DataFrame) -> DataFrame:
    """The least conversation of each distinct sequence, and the hash of all that are equal to it."""
    order = whole.select("digest", "conv")
    sorted_ids = order.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv")
    pieces = sorted_ids.mapInArrow(_pieces, "digest binary, first long, text string")
    return pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(_hashed, ENDS)


def _nothing(spark) -> DataFrame:
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()
    return spark.createDataFrame([], ", ".join(f"{c} long" for c in names) + ", ends_sha256 string")


def trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of `sequences` (conv, at from 0 without gaps, digest, chars; the last row of each
    conversation has a null digest, which marks its end): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    small_batches(spark)
    symbols = stored(sequences, "symbols")
    longest, root, members = symbols.agg(
        F.max("at") + 1, F.min("conv"), F.count(F.when(F.col("digest").isNull(), 1))
    ).first()
    if longest is None:
        return _nothing(spark)
    levels = int(longest).bit_length()
    blocks, ones = _blocks(symbols, levels)
    whole = ones[0]
    for more in ones[1:]:
        whole = whole.unionByName(more)
    whole = stored(whole.select("conv", "digest", "len"), "whole")
    start = whole.groupBy("digest", "len").agg(F.min("conv").alias("item"), F.count("*").alias("n"))
    columns = ["root", "base", "item", "n", "len"]
    zero = F.lit(0).cast("long").alias("base")
    waiting = [stored(start.select(F.lit(root).cast("long").alias("root"), zero, "item", "n", "len", _level(F.col("len"))), "start")]
    uppers: list[DataFrame] = [None] * levels
    lowers: list[DataFrame] = [None] * levels
    for k in reversed(range(levels)):
        half = 1 << k
        due = [w.where(F.col("level") == k + 1).select(*columns) for w in waiting]
        if k + 1 < levels:
            full = lowers[k + 1].where(F.col("len") == 2 * half).select(*columns)
            due += [full, uppers[k + 1].select("root", "base", "item", "n", F.lit(2 * half).cast("long").alias("len"))]
        active = due[0]
        for d in due[1:]:
            active = active.unionByName(d)
        uppers[k], lowers[k] = _cut(active, blocks[k], half)
        waiting.append(lowers[k].where(F.col("len") < half).select(*columns, _level(F.col("len"))))

    ids = ["item", "base"]
    found = uppers[0].select("root", *ids, "n").unionByName(lowers[0].select("root", *ids, "n"))
    signs = symbols.select(F.col("conv").alias("item"), F.col("at").alias("base"), "chars", F.col("digest").isNull().alias("end"))
    found = stored(found.join(signs, ids), "found")
    nodes = found.where(~F.col("end")).select("root", *ids, "n", "chars")
    children = nodes.groupBy(F.col("root").alias("item"), (F.col("base") - 1).alias("base")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ids, "left").select(
        "root",
        *ids,
        "n",
        _zero("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"),
    )
    nodes = stored(nodes, "nodes")
    totals = _block_totals(uppers, nodes)
    below = _below(uppers, lowers, totals)
    ended = found.where("end").join(_ends(whole), "item").select(F.col("root").alias("item"), (F.col("base") - 1).alias("base"), "ends_sha256")

    at_root = (F.col("root") == root) & (F.col("base") == 0)
    leaves, saved = totals[-1].where(at_root).agg(*[F.sum(v) for v in VALUES]).first()
    branches = nodes.where(at_root).count()
    top = [(None, root, -1, members, branches, leaves or 1, saved or 0)]
    start_row = spark.createDataFrame(top, nodes.select("root", *ids, "n", "n_children", *VALUES).schema)
    under = below.select(*ids, *[F.col(v).alias(f"{v}_below") for v in VALUES])
    inner = nodes.join(under, ids, "left").select(
        "root", *ids, "n", "n_children", *[(F.col(v) + F.coalesce(f"{v}_below", F.lit(0))).alias(v) for v in VALUES]
    )
    every = inner.unionByName(start_row).join(ended, ids, "left")
    return every.select(
        F.col("item").alias("conv_id"),
        (F.col("base") + 1).alias("depth"),
        F.col("root").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(stored(turns(conversations), "turns"), block, shared))
