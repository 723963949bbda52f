"""Session settings shared by tests, the bench and scripts.

On a cluster the caller brings its own session; `checkpoint_dir` reads the shared
folder from that session.  Only a local session may fall back to a private folder;
elsewhere a missing setting is an error, as executors do not share a disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gavel")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def skew_settings(spark: SparkSession) -> None:
    """Let AQE split a hot join key even where that costs one more shuffle."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set here only if it has none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if not named and not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = named or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise to the reliable checkpoint folder; survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Spark (from 4.1 on) removes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts lineage, and later reads prune columns.

    The shuffle files of the write go with it: no other query can read them."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(FILE_CLEANUP, None)
    conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(FILE_CLEANUP) if before is None else conf.set(FILE_CLEANUP, before)
    removed_at_exit(df.sparkSession, path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Remove what `stored` wrote; nothing may read it any more."""
    context = table.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """Mark a scratch path for removal when the application ends."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per context; their Python has only what it is sent."""
    context = spark.sparkContext
    if getattr(context, "_gavel_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "gavel.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join("gavel", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._gavel_shipped = True
